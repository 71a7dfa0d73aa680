"""Secret scans: candidates by pattern, false positives removed by a random forest."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import shared_path
from .text import slices

#: Candidates besides private key blocks: a credential in a URL, a value assigned to a telling name, or a long run.
PATTERN = re.compile(
    r"(?<=://)[^\s:/@]*:[^\s:/@]+(?=@)"
    r"|(?<![A-Za-z0-9+/_.-])[A-Za-z0-9+/_.-]{16,}={0,2}"
    r"|(?<=[:=])[ \t]*[\"'][^\"'\s]{6,}[\"']"
)
#: A value given to a telling name, of any form and length: quoted to the end of the quotes, else to the next space or
#: bracket. A name is tried once, from its beginning, so the work grows with the length of a text.
NAMED = re.compile(
    r"(?i)(?<![A-Za-z0-9_-])(?=[A-Za-z0-9_-]*?(?:password|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential))"
    r"[A-Za-z0-9_-]++[\"']?[ \t]*+(?:=>|:=|[:=])[ \t]*+(\"[^\"\n]+\"|'[^'\n]+'|[^\s\"'<>,;(){}\[\]]+)"
)
#: Parts of which each telling name has one: most texts have none, and are not searched for names.
_STEMS = ("passw", "passphrase", "pwd", "secret", "token", "credential", *(f"{a}{mark}key" for a in ("api", "access", "private") for mark in ("", "_", "-")))
#: The first and the last line of a private key block; all between is the key, headers and hyphens too. Without a last
#: line the key is what follows in lines of its letters.
KEY_MARK = re.compile(r"-----(BEGIN|END) [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----")
_KEY_LINES = re.compile(r"(?:\r?\n[A-Za-z0-9+/=]{16,})*")
KINDS = ("private_key", "url_credential", "assigned", "token")
#: Prefixes by which issuers mark their keys.
ISSUED = ("AKIA", "ASIA", "ghp_", "gho_", "ghs_", "github_pat_", "glpat-", "sk_live_", "sk-", "rk_live_", "xoxb-", "xoxp-", "AIza", "eyJ", "npm_", "pypi-", "SG.", "hf_")
#: Words near a secret, near something that only looks like one, and in paths of examples.
TELLING = re.compile(r"(?i)pass(?:word|wd)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|bearer|credential|private[_-]?key")
HARMLESS = re.compile(r"(?i)sha-?\d*|md5|commit|checksum|digest|hash|uuid|guid|etag|integrity|revision|example|sample|dummy|placeholder|version|build|image|id\b")
EXAMPLE_PATH = re.compile(r"(?i)test|example|sample|fixture|doc|readme|mock|demo")
#: Words whose share of a candidate's letters is its dictionary coverage.
DICTIONARY = (
    "access account admin and api app auth base build change client code config connect content control data default demo dev document "
    "dummy enter error example file for from function get group handler hash here host http image index info insert key lib list local "
    "login main manager message model module my name new node not number object option page param pass password path place placeholder "
    "prod project public read report request response result root sample secret server service session set setting source src state "
    "string super system table temp template test text the this time token type update upload url user utils value version view web "
    "window with word world write www your"
).split()
_DICTIONARY = re.compile("|".join(sorted((w for w in DICTIONARY if len(w) > 2), key=len, reverse=True)))
FEATURES = ("log_length", "entropy", "transitions", "coverage", "digits", "upper", "lower", "marks", "hex_only", "letter_pairs", "longest_run", "distinct", "issued", "dots_slashes", "telling_near", "telling_just_before", "harmless_near", "example_path", "key_block", "url_credential", "assigned", "uuid_form")
#: Characters of the neighbouring words on either side.
NEAR = 48
TREES, DEPTH, EXAMPLES = 30, 8, 4000

_VOWELS = set("aeiouyAEIOUYäöüéèêàáíóúñç")
_UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")


def _class(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def describe(value: str, kind: str, before: str, after: str, path: str) -> list[float]:
    """The features of one candidate, over its whole value."""
    v = value
    n = max(len(v), 1)
    classes = [_class(c) for c in v]
    shares = [classes.count(k) / n for k in range(4)]
    moves = sum(a != b for a, b in zip(classes, classes[1:], strict=False)) / max(n - 1, 1)
    both = [(a in _VOWELS) != (b in _VOWELS) for a, b in zip(v, v[1:], strict=False) if a.isalpha() and b.isalpha()]
    counts = Counter(v)
    entropy = -sum(k / n * math.log2(k / n) for k in counts.values())
    run = longest = 1
    for a, b in zip(v, v[1:], strict=False):
        run = run + 1 if a == b else 1
        longest = max(longest, run)
    covered = sum(len(m.group()) for m in _DICTIONARY.finditer(v.lower())) / n
    near = before[-NEAR:] + " " + after[:NEAR]
    just = before[-24:]
    return [
        math.log(len(value) + 1), entropy, moves, covered, shares[0], shares[2], shares[1], shares[3],
        float(all(c in "0123456789abcdefABCDEF" for c in v)), sum(both) / max(len(both), 1), longest / n, len(counts) / n,
        float(v.startswith(ISSUED)), (v.count(".") + v.count("/")) / n, float(bool(TELLING.search(near))), float(bool(TELLING.search(just))),
        float(bool(HARMLESS.search(near))), float(bool(EXAMPLE_PATH.search(path))), float(kind == "private_key"), float(kind == "url_credential"),
        float(kind == "assigned"), float(bool(_UUID.fullmatch(v))),
    ]


def candidates(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, kind) of everything in the text that might be a secret."""
    low = text.lower()
    others = _others if any(stem in low for stem in _STEMS) else _unnamed
    at = 0
    for a, b in _key_blocks(text):
        yield from others(text, at, a)
        yield a, b, KINDS[0]
        at = b
    yield from others(text, at, len(text))


def _key_blocks(text: str) -> Iterator[tuple[int, int]]:
    """From each BEGIN to the END that follows it; a BEGIN before another, or before none, stands alone."""
    begin = None
    for m in KEY_MARK.finditer(text):
        if m.group(1) == "END":
            if begin:
                yield begin.start(), m.end()
            begin = None
        else:
            if begin:
                yield begin.start(), _KEY_LINES.match(text, begin.end(), m.start()).end()
            begin = m
    if begin:
        yield begin.start(), _KEY_LINES.match(text, begin.end()).end()


def _others(text: str, start: int, stop: int) -> Iterator[tuple[int, int, str]]:
    """Candidates of the other kinds between two places: values of telling names, and what lies between these."""
    for m in NAMED.finditer(text, start, stop):
        a, b = m.span(1)
        if "://" in text[a:b]:
            continue
        yield from _unnamed(text, start, a)
        quoted = text[a] in "\"'"
        yield a + quoted, b - quoted, KINDS[2]
        start = b
    yield from _unnamed(text, start, stop)


def _unnamed(text: str, start: int, stop: int) -> Iterator[tuple[int, int, str]]:
    for m in PATTERN.finditer(text, start, stop):
        a, b = m.span()
        if b < len(text) and text[b] == "@" and ":" in text[a:b] and text[max(0, a - 3) : a] == "://":
            yield a, b, KINDS[1]
        elif text[b - 1] in "\"'" and b - a > 2:
            yield text.index(text[b - 1], a) + 1, b - 1, KINDS[2]
        else:
            run = text[a:b]
            if any(c.isdigit() for c in run) or (sum(c.isupper() for c in run) > 2 and any(c.islower() for c in run) and len(run) >= 20) or text[max(0, a - 1) : a] in ("=", '"', "'"):
                yield a, b, KINDS[3]


def example_findings(n: int = EXAMPLES, seed: int = 11) -> list[tuple[str, str, int]]:
    """Labelled findings (text with one candidate, path, 1 for a secret), made by rule from a seed.

    They stand in for a table of reviewed findings: keys of the common issuers, random hexadecimal and
    base64 keys behind telling names, passwords in URLs and assignments, short and unquoted ones too; against them
    checksums, commit ids, UUIDs, placeholders, identifiers, file names, paths, versions, words and code.
    """
    r = random.Random(seed)
    pick = lambda letters, k: "".join(r.choice(letters) for _ in range(k))
    hexa, upper, alnum = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    syllables = "er in the an re tion on at ent or es ing ver ich der una que ment le cion ado la".split()
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
    name = lambda: r.choice(["token", "secret", "password", "api_key", "apikey", "access_key", "auth_token", "client_secret", "passwd", "SECRET_KEY", "aws_secret_access_key", "bearer"])
    plain = lambda: r.choice(["id", "name", "value", "ref", "title", "class", "href", "file", "label", "lang"])
    loud = lambda: r.choice(["DB_PASSWORD", "PASSWORD", "ADMIN_PWD", "API_KEY", "SMTP_PASSWORD", "JWT_SECRET", "password", "passwd", "pwd", "secret", "api_key", "user_password"])
    mark = lambda: r.choice("!#$%&*?@-_.")
    short = lambda: r.choice([f"{word()}{r.randint(0, 9999)}", pick(alnum, r.randint(5, 14)), f"{word().title()}{r.randint(1, 99)}{mark()}", f"{word()}{mark()}{word()}{r.randint(0, 99)}", pick(alnum + "!#$%&*?", r.randint(5, 10)), pick(hexa, r.randint(8, 16))])
    good = [
        lambda: f"{loud()}{r.choice(['=', ': ', ' = ', ':'])}{short()}",
        lambda: f"export {loud().upper()}={short()}",
        lambda: f'{loud()}{r.choice(["=", ": ", " = "])}"{short()}"',
        lambda: f"{loud()}{r.choice(['=', ': '])}'{word()} {word()} {word()} {r.randint(1, 999)}'",
        lambda: f"{r.choice(['ftp', 'https', 'redis', 'smtp'])}://{word()}:{short()}@{word()}.example.org",
        lambda: f'{name()} = "{pick(hexa, r.choice([32, 40, 48, 64]))}"',
        lambda: f"{name()}={pick(alnum, r.randint(20, 64))}",
        lambda: f'{name()}: "{pick(alnum + "+/", r.choice([40, 44, 64]))}"',
        lambda: f"{r.choice(['AKIA', 'ASIA'])}{pick(upper, 16)}",
        lambda: f"{r.choice(['ghp_', 'gho_', 'ghs_'])}{pick(alnum, 36)}",
        lambda: f"{r.choice(['sk_live_', 'rk_live_', 'sk-', 'hf_', 'npm_'])}{pick(alnum, r.choice([24, 32, 48]))}",
        lambda: f"{r.choice(['xoxb-', 'xoxp-'])}{pick('0123456789', 12)}-{pick(alnum, 24)}",
        lambda: f"AIza{pick(alnum + '-_', 35)}",
        lambda: f"eyJ{pick(alnum, 30)}.eyJ{pick(alnum, 60)}.{pick(alnum + '-_', 43)}",
        lambda: f"https://{word()}:{pick(alnum, r.randint(8, 20))}@{word()}.example.com/x",
        lambda: f"-----BEGIN {r.choice(['RSA ', 'EC ', ''])}PRIVATE KEY-----\n{pick(alnum + '+/', 64)}\n{pick(alnum + '+/', 64)}\n-----END RSA PRIVATE KEY-----",
        lambda: f'{name()} = "{pick(alnum + "!#%&*", r.randint(10, 24))}"',
    ]
    code = ["None", "null", "nil", "true", "false", "string", "str", "undefined", "required", "optional", "os.environ", "self.token", "config.get", "${TOKEN}", "$1", "%s", "?", "***", "...", "request.form", "process.env.TOKEN", "hidden", "redacted", "TODO", "changeme", "password", "secret"]
    bad = [
        lambda: f"{loud()}{r.choice(['=', ': ', ' = ', ':'])}{r.choice(code)}",
        lambda: f"{loud()}: {word()} {word()}",
        lambda: f'{loud()} = "{r.choice(code)}"',
        lambda: f"{r.choice(['commit', 'sha1', 'revision', 'checksum:'])} {pick(hexa, 40)}",
        lambda: f"{r.choice(['md5', 'etag', 'digest', 'hash'])}: {pick(hexa, 32)}",
        lambda: f"sha256-{pick(hexa, 64)}",
        lambda: f"{r.choice(['uuid', 'id', 'guid', 'ref'])} = {pick(hexa, 8)}-{pick(hexa, 4)}-{pick(hexa, 4)}-{pick(hexa, 4)}-{pick(hexa, 12)}",
        lambda: f'{name()} = "{r.choice(["your_api_key_here", "changeme", "xxxxxxxxxxxxxxxx", "example_password", "<password>", "insert-token-here", "my_secret_value", "0000000000000000", "********"])}"',
        lambda: f"{word()}_{word()}_{word()}_{r.randint(1, 99)}_{word()}{word()}",
        lambda: f"/{word()}/{word()}-{r.randint(1, 999)}/{word()}{word()}.html",
        lambda: f"{word()}{word()}{word()}{word()}-{word()}{word()}{r.randint(0, 9)}",
        lambda: f"{r.randint(10**15, 10**16 - 1)}",
        lambda: f"+{r.randint(1, 99)}-{r.randint(100, 999)}-{r.randint(1000000, 9999999)}-{r.randint(10, 99)}",
        lambda: f"{word()}.{r.randint(1, 99)}mail{r.randint(1, 9)}.{word()}.example.com",
        lambda: f'{plain()} = "{word()}{word()}"',
        lambda: f"{word().upper()}{word().upper()}{r.randint(1, 9)}{word().upper()}{word().upper()}{word()}",
        lambda: f"20{r.randint(10, 30)}-0{r.randint(1, 9)}-1{r.randint(0, 9)}T0{r.randint(1, 9)}-{r.randint(10, 59)}-00.{r.randint(100, 999)}Z",
        lambda: f"{word()}-v{r.randint(1, 9)}.{r.randint(0, 20)}.{r.randint(0, 9)}-{word()}.tar.gz",
    ]
    out = []
    for i in range(n):
        label = i % 2
        body = r.choice(good if label else bad)()
        path = r.choice(["src0", "src7", f"{word()}/{word()}.py", f"conf/{word()}.yaml", ""] + ["tests/example.md"] * (not label))
        out.append((f"{' '.join(word() for _ in range(r.randint(0, 6)))} {body} {' '.join(word() for _ in range(r.randint(0, 6)))}", path, label))
    return out


def labelled_features(findings: list[tuple[str, str, int]]) -> list[tuple[list[float], float]]:
    """Features and label of each labelled finding's longest candidate; findings without one are left out."""
    out = []
    for text, path, label in findings:
        found = max(candidates(text), key=lambda c: c[1] - c[0], default=None)
        if found:
            a, b, kind = found
            out.append((describe(text[a:b], kind, text[:a], text[b:], path), float(label)))
    return out


class Forest:
    """The nodes of a fitted forest as arrays, for use in tasks."""

    def __init__(self, rows: list):
        trees = sorted({r["treeID"] for r in rows})
        self.trees = []
        for t in trees:
            nodes = sorted((r["nodeData"] for r in rows if r["treeID"] == t), key=lambda x: x["id"])
            feature = np.array([x["split"]["featureIndex"] if x["leftChild"] >= 0 else 0 for x in nodes])
            cut = np.array([x["split"]["leftCategoriesOrThreshold"][0] if x["leftChild"] >= 0 else 0.0 for x in nodes])
            left, right = (np.array([x[k] if x["leftChild"] >= 0 else x["id"] for x in nodes]) for k in ("leftChild", "rightChild"))
            stats = np.array([x["impurityStats"] for x in nodes], float)
            self.trees.append((feature, cut, left, right, stats[:, 1] / np.maximum(stats.sum(axis=1), 1e-12)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for feature, cut, left, right, share in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = np.where(x[np.arange(len(x)), feature[at]] <= cut[at], left[at], right[at])
            total += share[at]
        return total / max(len(self.trees), 1)


def fit(spark: SparkSession, findings: list[tuple[str, str, int]] | None = None, seed: int = 5) -> Forest:
    """A forest from labelled findings (by default those made by rule); their number bounds the work."""
    rows = labelled_features(example_findings() if findings is None else findings)
    columns = pa.table({"features": pa.array([x for x, _ in rows], pa.list_(pa.float64())), "label": pa.array([y for _, y in rows], pa.float64())})
    table = spark.createDataFrame(columns).coalesce(1).select(array_to_vector("features").alias("features"), "label")
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, featureSubsetStrategy="sqrt").fit(table)
    path = shared_path(spark, "secret-forest")
    model.save(path)
    return Forest(spark.read.parquet(f"{path}/data").select("treeID", "nodeData").collect())  # trees x 2^depth rows at most


def scan(text: str | None, path: str | None, forest: Forest) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, probability) of each candidate of a whole text."""
    text = text or ""
    found = list(candidates(text))
    if not found:
        return []
    x = np.array([describe(text[a:b], kind, text[max(0, a - NEAR) : a], text[b : b + NEAR], path or "") for a, b, kind in found])
    return [(a, b, kind, float(p)) for (a, b, kind), p in zip(found, forest.probability(x), strict=True)]


def find_secrets(docs: DataFrame, forest: Forest, cut: float = 0.5) -> DataFrame:
    """One row per candidate: ``doc_id``, ``finding`` (from 0 in each text), ``start``, ``length``, ``kind``,
    ``value_sha256``, ``score`` and ``is_secret``.

    ``source`` is the path; it may be null or missing. Places count characters. The values are given as hashes only.
    A null or empty text has no candidate; repeated rows are scanned each; a null doc_id stays null. Other columns are
    left out; an empty table gives an empty one.
    """
    sent = docs.sparkSession.sparkContext.broadcast(forest)
    schema = "doc_id long, finding int, start long, length long, kind string, value_sha256 string, score double"
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, value, path in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                text = value.as_py()
                for i, (a, b, kind, p) in enumerate(scan(text, path, sent.value)):
                    out.append((doc, i, a, b - a, kind, hashlib.sha256(text[a:b].encode()).hexdigest(), p))
            cols = list(zip(*out, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    found = docs.select(F.col("doc_id").cast("long"), "text", _path(docs)).mapInArrow(run, schema)
    return found.withColumn("is_secret", F.col("score") >= cut)


def _path(docs: DataFrame) -> Column:
    return (F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")).alias("path_")


def redact(docs: DataFrame, forest: Forest, cut: float = 0.5, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every secret in ``text`` replaced by ``mark``; all rows and all other columns stay.

    ``source`` is the path; it may be null or missing. Null and empty texts stay as they are, repeated rows are
    redacted each, and an empty table gives an empty one.
    """
    sent = docs.sparkSession.sparkContext.broadcast(forest)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for value, path in zip(batch.column(at), batch.column(len(batch.columns) - 1).to_pylist(), strict=True):
                text = value.as_py()
                for a, b, _, p in reversed(scan(text, path, sent.value)):
                    if p >= cut:
                        text = text[:a] + mark + text[b:]
                out.append(text)
            columns = list(batch.columns)[:-1]
            columns[at] = pa.array(out, batch.column(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return docs.select("*", _path(docs)).mapInArrow(run, docs.schema)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return find_secrets(docs, fit(spark))
