"""Pixel helpers in NumPy: the candidate transforms, and raw sums over areas of an image; all else is left to Spark.

Images are uint8 arrays of height x width x 3 in BGR order. Helpers follow the public definitions of the common image
libraries, with borders mirrored about the edge pixel; results may differ from those in the last digits.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view


def as_bgr(image: np.ndarray | None) -> np.ndarray:
    if image is None or image.ndim != 3 or image.shape[2] != 3 or not image.size:
        raise ValueError("an image has height, width and three channels")
    return image if image.dtype == np.uint8 else np.clip(image, 0, 255).astype(np.uint8)


def pixels_of(data: bytes | None, height: int | None, width: int | None) -> np.ndarray | None:
    """An image in BGR from its bytes: three channels as they are, one repeated, of four the first three; else none."""
    if not data or not height or not width or height < 0 or width < 0 or len(data) not in (height * width, 3 * height * width, 4 * height * width):
        return None
    x = np.frombuffer(data, np.uint8).reshape(height, width, -1)
    return np.ascontiguousarray(np.repeat(x, 3, axis=2) if x.shape[2] == 1 else x[..., :3])


def mirrored(x: np.ndarray, r: int) -> np.ndarray:
    """Pads the last two axes by ``r``."""
    return np.pad(x, [(0, 0)] * (x.ndim - 2) + [(r, r)] * 2, mode="reflect")


def blur(x: np.ndarray, taps: tuple[float, ...]) -> np.ndarray:
    """A separable blur of the last two axes."""
    r, h, w = len(taps) // 2, x.shape[-2], x.shape[-1]
    p = mirrored(x, r)
    rows = sum(np.float32(t) * p[..., i : i + h, :] for i, t in enumerate(taps))
    return sum(np.float32(t) * rows[..., i : i + w] for i, t in enumerate(taps))


#: Fixed taps of the Gaussian blurs of sizes 3 and 5.
TAPS_3, TAPS_5 = (0.25, 0.5, 0.25), (0.0625, 0.25, 0.375, 0.25, 0.0625)


def laplacian(g: np.ndarray) -> np.ndarray:
    p = mirrored(g, 1)
    return p[..., :-2, 1:-1] + p[..., 2:, 1:-1] + p[..., 1:-1, :-2] + p[..., 1:-1, 2:] - 4 * g


def sobel(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = mirrored(g, 1)
    across, down = p[..., 2:] - p[..., :-2], p[..., 2:, :] - p[..., :-2, :]
    gx = across[..., :-2, :] + 2 * across[..., 1:-1, :] + across[..., 2:, :]
    return gx, down[..., :-2] + 2 * down[..., 1:-1] + down[..., 2:]


def dilate3(x: np.ndarray) -> np.ndarray:
    """Each pixel or any neighbour of it, over the last two axes."""
    p = np.pad(x, [(0, 0)] * (x.ndim - 2) + [(1, 1)] * 2)
    rows = p[..., :-2, :] | p[..., 1:-1, :] | p[..., 2:, :]
    return rows[..., :-2] | rows[..., 1:-1] | rows[..., 2:]


def erode(x: np.ndarray, size: int) -> np.ndarray:
    """The least value within a square of ``size`` about each pixel; beyond the edges there is none."""
    for axis in (0, 1):
        least, have = np.pad(x, [(size // 2,) * 2 if i == axis else (0, 0) for i in (0, 1)], mode="constant", constant_values=np.inf), 1
        while have < size:  # least values of longer and longer runs
            step = min(have, size - have)
            least, have = _least_of(least, step, axis), have + step
        x = least
    return x


def _least_of(x: np.ndarray, step: int, axis: int) -> np.ndarray:
    return np.minimum(x[:-step], x[step:]) if axis == 0 else np.minimum(x[:, :-step], x[:, step:])


def gray(image: np.ndarray) -> np.ndarray:
    """Whole gray values, halves rounded up."""
    b, g, r = (image[..., i].astype(np.int32) for i in range(3))
    return ((114 * b + 587 * g + 299 * r + 500) // 1000).astype(np.float32)


_LINEAR = np.arange(256) / 255.0
_LINEAR = np.where(_LINEAR > 0.04045, ((_LINEAR + 0.055) / 1.055) ** 2.4, _LINEAR / 12.92).astype(np.float32)
#: Fixed matrices between linear RGB and XYZ, the latter divided by the white point.
_TO_XYZ = np.array([[0.412453, 0.357580, 0.180423], [0.212671, 0.715160, 0.072169], [0.019334, 0.119193, 0.950227]]) / np.array([[0.950456], [1.0], [1.088754]])
_FROM_XYZ = np.array([[3.240479, -1.53715, -0.498535], [-0.969256, 1.875991, 0.041556], [0.055648, -0.204043, 1.057311]]) * np.array([0.950456, 1.0, 1.088754])


def to_lab(image: np.ndarray) -> np.ndarray:
    """CIE Lab of a uint8 image with L in 0..255 and a, b around 128."""
    xyz = _LINEAR[image[..., ::-1]] @ _TO_XYZ.T.astype(np.float32)
    f = np.where(xyz > 0.008856, np.cbrt(xyz), 7.787 * xyz + np.float32(16 / 116))
    y = xyz[..., 1]
    lum = np.where(y > 0.008856, 116 * f[..., 1] - 16, np.float32(903.3) * y)
    return np.stack([lum * np.float32(2.55), 500 * (f[..., 0] - f[..., 1]) + 128, 200 * (f[..., 1] - f[..., 2]) + 128], axis=-1)


def whole_lab(image: np.ndarray) -> np.ndarray:
    """Lab in whole numbers from 0 to 255."""
    return np.clip(np.rint(to_lab(image)), 0, 255)


def from_lab(lab: np.ndarray) -> np.ndarray:
    lab = lab.astype(np.float32)
    fy = (lab[..., 0] / np.float32(2.55) + 16) / 116
    f = np.stack([fy + (lab[..., 1] - 128) / 500, fy, fy - (lab[..., 2] - 128) / 200], axis=-1)
    cube = f * f * f
    x = np.where(cube > 0.008856, cube, (f - np.float32(16 / 116)) / np.float32(7.787)) @ _FROM_XYZ.T.astype(np.float32)
    x = np.where(x > 0.0031308, np.float32(1.055) * np.power(np.maximum(x, 0), np.float32(1 / 2.4)) - np.float32(0.055), np.float32(12.92) * x)
    return np.clip(np.rint(x[..., ::-1] * 255), 0, 255).astype(np.uint8)


def white_balance(image: np.ndarray) -> np.ndarray:
    means = image.reshape(-1, 3).mean(axis=0)
    gains = np.clip(means.mean() / np.maximum(means, 1e-6), 0.85, 1.15)
    tables = np.clip(np.arange(256)[:, None] * gains, 0, 255).astype(np.uint8)
    return np.stack([tables[:, c][image[..., c]] for c in range(3)], axis=-1)


def adaptive_gamma(image: np.ndarray, strength: float) -> np.ndarray:
    b = min(max(gray(image).mean(dtype=float) / 255, 0.01), 0.99)
    g = min(max(np.log(0.48) / np.log(b), 0.75), 1.25)
    g = min(max(1 + strength * (g - 1), 0.75), 1.25)
    return np.clip((np.arange(256) / 255.0) ** g * 255, 0, 255).astype(np.uint8)[image]


def clahe(image: np.ndarray, clip: float = 1.25, tiles: int = 8) -> np.ndarray:
    """Contrast-limited equalisation of the lightness, tile by tile, blended between tile centres."""
    lab = to_lab(image)
    light = np.clip(np.rint(lab[..., 0]), 0, 255).astype(int)
    h, w = light.shape
    th, tw = -(-h // tiles), -(-w // tiles)
    full = np.pad(light, ((0, th * tiles - h), (0, tw * tiles - w)), mode="edge")
    limit = max(int(clip * th * tw / 256), 1)
    cells = full.reshape(tiles, th, tiles, tw).swapaxes(1, 2).reshape(tiles * tiles, -1)
    hist = np.bincount((cells + 256 * np.arange(len(cells))[:, None]).ravel(), minlength=256 * len(cells)).reshape(-1, 256)
    extra = np.maximum(hist - limit, 0).sum(axis=1)
    hist = np.minimum(hist, limit) + (extra // 256)[:, None]
    for row, rest in zip(hist, (extra % 256).tolist(), strict=True):
        if rest:
            row[:: max(256 // rest, 1)][:rest] += 1
    tables = np.clip(np.rint(np.cumsum(hist, axis=1) * 255 / (th * tw)), 0, 255).astype(np.float32).reshape(tiles, tiles, 256)
    y, x = (np.arange(h) / th - 0.5).astype(np.float32), (np.arange(w) / tw - 0.5).astype(np.float32)
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    fy, fx = (y - y0)[:, None], (x - x0)[None, :]
    at = lambda a, b: tables[np.clip(a, 0, tiles - 1)[:, None], np.clip(b, 0, tiles - 1)[None, :], light]
    lab[..., 0] = (1 - fy) * ((1 - fx) * at(y0, x0) + fx * at(y0, x0 + 1)) + fy * ((1 - fx) * at(y0 + 1, x0) + fx * at(y0 + 1, x0 + 1))
    return from_lab(lab)


def bilateral(image: np.ndarray, sigma: float = 20.0) -> np.ndarray:
    """Edge-keeping blur over the neighbours at a distance of one."""
    by_step = np.exp(-(np.arange(766) ** 2) / (2 * sigma**2)).astype(np.float32)
    x = image.astype(np.int16)
    p = np.pad(x, ((1, 1), (1, 1), (0, 0)), mode="reflect")
    h, w = image.shape[:2]
    total, weights = x.astype(np.float32), np.ones((h, w, 1), np.float32)
    for dy, dx in ((-1, 0), (1, 0), (0, -1), (0, 1)):
        near = p[1 + dy : 1 + dy + h, 1 + dx : 1 + dx + w]
        k = by_step[np.abs(near - x).sum(axis=2)][..., None] * np.float32(np.exp(-1 / (2 * sigma**2)))
        total, weights = total + k * near, weights + k
    return np.clip(np.rint(total / weights), 0, 255).astype(np.uint8)


_HAZE: list = [None, None]


def _haze(image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The image from 0 to 1, its air light and its dark channel over that light; kept for the last image, which has two dehazed candidates."""
    if _HAZE[0] is not image:
        x = image.astype(np.float32) / np.float32(255)
        dark = erode(x.min(axis=2), 15)
        n = max(1, int(dark.size * 0.001))
        air = np.maximum(x.reshape(-1, 3)[np.argsort(-dark.ravel(), kind="stable")[:n]].mean(axis=0), np.float32(0.10))
        _HAZE[:] = image, (x, air, erode((x / air).min(axis=2), 15))
    return _HAZE[1]


def dehaze(image: np.ndarray, blend: float, omega: float) -> np.ndarray:
    x, air, dark = _haze(image)
    through = np.clip(blur(1 - np.float32(omega) * dark, TAPS_5), 0.6, 1.0)[..., None]
    clear = np.clip((x - air) / through + air, 0, 1)
    return np.clip((np.float32(1 - blend) * x + np.float32(blend) * clear) * 255, 0, 255).astype(np.uint8)


TRANSFORMS: dict[str, Callable[[np.ndarray], np.ndarray]] = {
    "adaptive_gamma_light": lambda x: adaptive_gamma(x, 0.55),
    "adaptive_gamma_standard": lambda x: adaptive_gamma(x, 1.0),
    "mild_dehaze_low": lambda x: dehaze(x, 0.20, 0.40),
    "mild_dehaze_medium": lambda x: dehaze(x, 0.35, 0.50),
    "white_balance_conservative": white_balance,
    "clahe_very_mild": clahe,
    "bilateral_denoise_mild": bilateral,
}


def edge_pixels(g: np.ndarray, low: float = 50, high: float = 150) -> int:
    """Edge pixels: gradient peaks along their direction, strong ones and weak ones joined to them."""
    gx, gy = sobel(g)
    ax, ay = np.abs(gx), np.abs(gy)
    size = ax + ay
    p = np.pad(size, 1)
    h, w = g.shape
    flat, steep = ay < np.float32(0.41421356) * ax, ay > np.float32(2.41421356) * ax
    slant = np.where((gx < 0) == (gy < 0), 1, 2)
    turn = np.where(flat, 0, np.where(steep, 3, slant))
    peak = np.zeros(size.shape, bool)
    for k, (dy, dx) in enumerate(((0, 1), (1, 1), (1, -1), (1, 0))):
        a, b = p[1 + dy : 1 + dy + h, 1 + dx : 1 + dx + w], p[1 - dy : 1 - dy + h, 1 - dx : 1 - dx + w]
        peak |= (turn == k) & (size >= a) & (size > b)
    weak, edges = peak & (size > low), peak & (size > high)
    return int(np.count_nonzero(_joined(weak, edges)))


def _joined(weak: np.ndarray, strong: np.ndarray) -> np.ndarray:
    """The weak pixels whose connected region, corners included, has a strong one. Labels run to the least of a region, each
    round also along the labels themselves, so rounds grow with the logarithm of the longest path."""
    number = np.full((weak.shape[0] + 2, weak.shape[1] + 2), -1)
    inner = number[1:-1, 1:-1]
    inner[weak] = np.arange(np.count_nonzero(weak))
    near = [(number[1 + dy : 1 + dy + weak.shape[0], 1 + dx : 1 + dx + weak.shape[1]], inner) for dy, dx in ((0, 1), (1, -1), (1, 0), (1, 1))]
    u, v = (np.concatenate([x[(a >= 0) & (b >= 0)] for a, b in near for x in [(a, b)[side]]]) for side in (0, 1))
    root = np.arange(np.count_nonzero(weak))
    while True:
        new, least = root.copy(), np.minimum(root[u], root[v])
        np.minimum.at(new, root[u], least)
        np.minimum.at(new, root[v], least)
        new = new[new]
        if (new == root).all():
            break
        root = new
    kept = np.zeros(len(root), bool)
    kept[root[strong[weak]]] = True
    return kept[root]


def _moments(x: np.ndarray) -> tuple[float, float]:
    x = x.astype(float).ravel()
    return float(x.sum()), float(x @ x)


def image_sums(image: np.ndarray, g: np.ndarray, lab: np.ndarray) -> dict:
    """Sums over a whole image (with its gray values and its Lab) of what its quality is worked out from, and the histogram of its gray values."""
    b, gr, r = (image[..., i].astype(np.float32) for i in range(3))
    chroma = np.hypot(lab[..., 1] - 128, lab[..., 2] - 128)
    top = image.max(axis=2).astype(np.float32)
    light = np.percentile(lab[..., 0], [1, 99])
    hist = np.bincount(g.astype(np.int64).ravel(), minlength=256)
    out = {"n": float(g.size), "b_sum": float(b.sum(dtype=float)), "g_sum": float(gr.sum(dtype=float)), "r_sum": float(r.sum(dtype=float)), "hist": hist.tolist(), "edges": float(edge_pixels(g)), "light_1": float(light[0]), "light_99": float(light[1])}
    for name, x in (("lap", laplacian(g)), ("noise", g - blur(g, TAPS_3)), ("rg", r - gr), ("yb", np.float32(0.5) * (r + gr) - b), ("chroma", chroma)):
        out[f"{name}_sum"], out[f"{name}_sq"] = _moments(x)
    out["purity_sum"] = float((chroma / (np.hypot(chroma, lab[..., 0]) + np.float32(1e-6))).sum(dtype=float))
    out["hsv_sum"] = float(np.rint(np.where(top > 0, (top - image.min(axis=2)) * 255 / np.maximum(top, 1), 0)).sum(dtype=float) / 255)
    return out


class Side:
    """One image's gray values over areas of equal size (areas x height x width), with the sums of each area."""

    def __init__(self, g: np.ndarray):
        self.size = np.hypot(*sobel(g))
        n = g[0].size
        flat = np.sort(self.size.reshape(len(g), n), axis=1)
        some = np.count_nonzero(flat > 0, axis=1)
        at = n - some + 0.75 * np.maximum(some - 1, 0)  # the upper quartile of the positive ones
        low = np.minimum(at.astype(int), n - 1)
        rows = np.arange(len(g))
        quartile = flat[rows, low] + (at - low) * (flat[rows, np.minimum(low + 1, n - 1)] - flat[rows, low])
        self.strong = self.size >= np.where(some > 0, quartile, np.inf).astype(np.float32)[:, None, None]
        self.sums = {}
        for name, x in (("gray", g), ("lap", laplacian(g)), ("noise", g - blur(g, TAPS_3)), ("size", self.size)):
            x = x.reshape(len(g), n).astype(float)
            self.sums[f"{name}_sum"], self.sums[f"{name}_sq"] = x.sum(axis=1), np.einsum("ij,ij->i", x, x)


def pair_sums(a: Side, b: Side) -> dict[str, np.ndarray]:
    """Per area the sums of the raw side (``a_``), of the candidate (``b_``) and of both together."""
    n = a.size[0].size
    flat = lambda x: x.reshape(len(x), n)
    return {
        "n": np.full(len(a.size), float(n)), **{f"a_{k}": v for k, v in a.sums.items()}, **{f"b_{k}": v for k, v in b.sums.items()},
        "size_both": np.einsum("ij,ij->i", flat(a.size).astype(float), flat(b.size).astype(float)),
        "alike": (np.abs(flat(a.size) - flat(b.size)) <= 1e-8 + 1e-5 * np.abs(flat(b.size))).all(axis=1).astype(float),
        "strong": flat(a.strong).sum(axis=1).astype(float), "strong_kept": (flat(a.strong) & flat(dilate3(b.strong))).sum(axis=1).astype(float),
    }


def shrink(image: np.ndarray, side: int) -> np.ndarray:
    """The image with its longest side at most ``side``, by means over areas, as uint8."""
    h, w = image.shape[:2]
    f = side / max(h, w)
    if f >= 1:
        return image

    def along(x: np.ndarray, n: int, m: int) -> np.ndarray:
        cuts = np.linspace(0, n, m + 1)
        sums = np.concatenate([np.zeros((1, *x.shape[1:])), np.cumsum(x, axis=0)])
        low = np.minimum(np.floor(cuts).astype(int), n - 1)
        part = sums[low] + (cuts - low).reshape(-1, *[1] * (x.ndim - 1)) * x[low]
        return np.diff(part, axis=0) * m / n

    nh, nw = max(1, int(h * f)), max(1, int(w * f))
    return np.clip(np.rint(along(along(image.astype(float), h, nh).swapaxes(0, 1), w, nw).swapaxes(0, 1)), 0, 255).astype(np.uint8)


def tile_bounds(h: int, w: int, n: int, least: int) -> list[tuple[int, int, int, int]]:
    """Tiles (top, bottom, left, right) of an n x n grid, without those smaller than ``least``."""
    ys, xs = ([round(i * s / n) for i in range(n + 1)] for s in (h, w))
    return [(y0, y1, x0, x1) for y0, y1 in zip(ys, ys[1:], strict=False) for x0, x1 in zip(xs, xs[1:], strict=False) if min(y1 - y0, x1 - x0) >= least]


def lab_distance(a: np.ndarray, b: np.ndarray) -> float:
    """Mean distance of the pixels of two images in Lab."""
    d = (a - b).reshape(-1, 3)
    return float(np.sqrt(np.einsum("ij,ij->i", d, d)).mean(dtype=float))


def lab_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The same of each pair of areas of equal size (areas x height x width x 3)."""
    d = (a - b).reshape(len(a), -1, 3)
    return np.sqrt(np.einsum("nij,nij->ni", d, d)).mean(axis=1, dtype=float)
