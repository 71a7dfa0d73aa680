"""Reports and manifests: small JSON and YAML texts, written whole or not at all, and tables as CSV or JSON lines."""

from __future__ import annotations

import json
import uuid

import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed columns of the decisions of a trial, in their order.
DECISION_COLUMNS = [
    "sample_number", "sample_type", "selection_reason", "prepared_image", "target_count", "tiny_count", "small_count", "medium_large_count",
    "winner_mode", "winner_risk", "winner_benefit_score", "winner_safety_margin", "processed_selected",
]
#: Fixed columns of the manifest of a run, in their order.
MANIFEST_COLUMNS = [
    "source_prepared_image", "output_image", "split", "deployment", "target_count", "selected_mode", "processed", "winner_benefit_score",
    "winner_safety_margin", "source_image_sha256", "output_image_sha256", "source_label_sha256", "output_label_sha256",
]


def write_text(uri: str, text: str) -> None:
    """Replaces the file by ``text``; a reader sees the old or the new text, never a part."""
    fs, path = pyarrow.fs.FileSystem.from_uri(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(part) as f:
        f.write(text.encode())
    fs.move(part, path)


def write_json(uri: str, value: object) -> None:
    write_text(uri, json.dumps(value, indent=2, ensure_ascii=False) + "\n")


def read_json(uri: str) -> object:
    """The file's object; a missing file is an error."""
    fs, path = pyarrow.fs.FileSystem.from_uri(uri)
    with fs.open_input_stream(path) as f:
        return json.loads(f.read())


def read_object(uri: str) -> dict:
    """The file's object; empty where the file is missing or holds something else."""
    try:
        found = read_json(uri)
    except (FileNotFoundError, ValueError):
        return {}
    return found if isinstance(found, dict) else {}


def dataset_yaml(path: str, names: dict[int, str], with_count: bool = False) -> str:
    """The text that tells a trainer where each split's images are and what the classes are called."""
    lines = [f"path: {json.dumps(path, ensure_ascii=False)}", "train: train/images", "val: val/images", "test: test/images", "names:"]
    lines += [f"  {k}: {json.dumps(v, ensure_ascii=False)}" for k, v in sorted(names.items())]
    return "\n".join([*lines, *([f"nc: {len(names)}"] if with_count else [])]) + "\n"


def write_decisions(decisions: DataFrame, uri: str) -> None:
    """Decisions as CSV with a header, in their order; those of a trial, a few dozen, are one file."""
    decisions.select(DECISION_COLUMNS).orderBy("sample_number").write.mode("overwrite").option("header", True).csv(uri)


def write_manifest(manifest: DataFrame, uri: str) -> None:
    """The manifest sorted by source, as JSON lines of all columns and as CSV of the fixed ones (null if missing)."""
    by_source = manifest.orderBy("source_prepared_image")
    by_source.write.mode("overwrite").option("ignoreNullFields", False).json(f"{uri}/jsonl")
    fixed = [F.col(c) if c in manifest.columns else F.lit(None).cast("string").alias(c) for c in MANIFEST_COLUMNS]
    by_source.select(fixed).write.mode("overwrite").option("header", True).csv(f"{uri}/csv")
