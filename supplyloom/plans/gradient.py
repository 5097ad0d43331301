"""Loss and gradient of one Arrow batch of training examples.

This is the per-task helper of the training job: Spark has already sampled,
joined and laid out the rows; here they are read as matrices. Everything
returned is a sum over rows, so the result does not depend on partitioning.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from supplyloom.plans.examples import NO_EDGE, Shape


def records_of(blocks: pa.Array, size: int) -> np.ndarray:
    """Fixed-size binary records as bytes ``[n, size]``, without a copy."""
    n = len(blocks)
    _, offsets, data = blocks.buffers()
    start = np.frombuffer(offsets, np.int32)[blocks.offset] if n else 0
    return np.frombuffer(data, np.uint8, n * size, start).reshape(n, size) if n else np.empty((0, size), np.uint8)


def _fields(records: np.ndarray, shape: Shape, drop: np.ndarray | None, width: int | None = None) -> dict:
    """The vectors and neighbour masks of ``n`` blocks; edges in ``drop`` [n] are masked out.

    ``width``: only that many numbers of each vector.
    """
    n, f, d = len(records), shape.fanout, shape.width
    split = 4 * sum(shape.vector_sizes)
    vectors = np.ascontiguousarray(records[:, :split]).view(np.float32).astype(float)
    eids = np.ascontiguousarray(records[:, split:]).view(np.int64)
    x, x1, x2, x21 = np.split(vectors, np.cumsum(shape.vector_sizes)[:-1], axis=1)
    present = eids != NO_EDGE
    if drop is not None:
        present &= eids != drop[:, None]
    m1, m2, m21 = np.split(present.astype(float), np.cumsum(shape.edge_sizes)[:-1], axis=1)
    x1, x2, x21 = x1.reshape(n, f, d), x2.reshape(n, f, d), x21.reshape(n, f, f, d)
    return {
        "x": x[:, :width], "x1": x1[..., :width], "x2": x2[..., :width], "x21": x21[..., :width],
        "m1": m1, "m2": m2, "m21": m21.reshape(n, f, f),
    }


def _layer(w: dict, name: str, own: np.ndarray, near: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, tuple]:
    """``own`` [n, d], ``near`` [n, f, d], ``mask`` [n, f] -> output and what backward needs."""
    if f"{name}.w_pool" in w:
        pooled = np.maximum(near @ w[f"{name}.w_pool"].T + w[f"{name}.b_pool"], 0.0) * mask[..., None]
        best = pooled.argmax(axis=1)
        agg = np.take_along_axis(pooled, best[:, None, :], axis=1)[:, 0, :]
        kept = (pooled, best)
    else:
        share = mask / np.maximum(mask.sum(axis=1, keepdims=True), 1.0)
        agg = np.einsum("nf,nfd->nd", share, near)
        kept = share
    out = own @ w[f"{name}.w_self"].T + agg @ w[f"{name}.w_neigh"].T + w[f"{name}.bias"]
    return out, (own, near, agg, kept)


def _layer_back(w: dict, g: dict, name: str, d_out: np.ndarray, cache: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Adds the weight gradients to ``g``; returns those of ``own`` and ``near``."""
    own, near, agg, kept = cache
    g[f"{name}.w_self"] += d_out.T @ own
    g[f"{name}.w_neigh"] += d_out.T @ agg
    g[f"{name}.bias"] += d_out.sum(axis=0)
    d_agg = d_out @ w[f"{name}.w_neigh"]
    if f"{name}.w_pool" in w:
        pooled, best = kept
        d_pool = np.zeros_like(pooled)
        np.put_along_axis(d_pool, best[:, None, :], d_agg[:, None, :], axis=1)
        d_pool *= pooled > 0  # neither rectified nor masked entries pass a gradient
        flat = d_pool.reshape(-1, d_pool.shape[-1])
        g[f"{name}.w_pool"] += flat.T @ near.reshape(-1, near.shape[-1])
        g[f"{name}.b_pool"] += flat.sum(axis=0)
        d_near = d_pool @ w[f"{name}.w_pool"]
    else:
        d_near = kept[..., None] * d_agg[:, None, :]
    return d_out @ w[f"{name}.w_self"], d_near


def _encode(w: dict, b: dict) -> tuple[np.ndarray, tuple]:
    n, f, d = b["x2"].shape
    z_own, c_own = _layer(w, "layer1", b["x"], b["x1"], b["m1"])
    z_near, c_near = _layer(
        w, "layer1", b["x2"].reshape(n * f, d), b["x21"].reshape(n * f, f, d), b["m21"].reshape(n * f, f)
    )
    near = np.maximum(z_near, 0.0).reshape(n, f, -1)
    h2, c_top = _layer(w, "layer2", np.maximum(z_own, 0.0), near, b["m2"])
    return h2, (z_own, c_own, z_near, c_near, c_top)


def _encode_back(w: dict, g: dict, d_h2: np.ndarray, cache: tuple) -> None:
    z_own, c_own, z_near, c_near, c_top = cache
    d_own, d_near = _layer_back(w, g, "layer2", d_h2, c_top)
    _layer_back(w, g, "layer1", d_own * (z_own > 0), c_own)
    _layer_back(w, g, "layer1", d_near.reshape(z_near.shape) * (z_near > 0), c_near)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.where(x >= 0, 1.0, np.exp(-np.abs(x))) / (1.0 + np.exp(-np.abs(x)))


def embedded(records: np.ndarray, w: dict, shape: Shape, width: int | None = None) -> np.ndarray:
    """Embeddings of the nodes of some blocks."""
    return _encode(w, _fields(records, shape, None, width))[0]


def _pair_logits(
    src: np.ndarray, dst: np.ndarray, row: np.ndarray, eid: np.ndarray | None, w: dict, shape: Shape, width: int | None
) -> tuple[np.ndarray, tuple]:
    h_src, c_src = _encode(w, _fields(src, shape, eid, width))
    h_dst, c_dst = _encode(w, _fields(dst, shape, None if eid is None else eid[row], width))
    half = h_src.shape[1]
    logits = (h_src @ w["score.w"][:half])[row] + h_dst @ w["score.w"][half:] + w["score.b"][0]
    return logits, (h_src, c_src, h_dst, c_dst)


def _pairs(batch: pa.RecordBatch, shape: Shape, exclude: bool) -> tuple:
    """Records of purchasers and of all slots, the row of each slot, and the edge ids to leave out."""
    others = batch.column("others")
    row = np.repeat(np.arange(batch.num_rows), np.diff(others.offsets.to_numpy()))
    eid = batch.column("eid").to_numpy(zero_copy_only=False) if exclude else None
    return records_of(batch.column("buyer"), shape.block_bytes), records_of(others.flatten(), shape.block_bytes), row, eid


def forward(batch: pa.RecordBatch, w: dict, shape: Shape, exclude: bool) -> tuple[np.ndarray, np.ndarray, tuple]:
    """Logits of all slots, the row each slot belongs to, and what backward needs.

    The first slot of a row is its seller, the others are its negatives.
    """
    src, dst, row, eid = _pairs(batch, shape, exclude)
    logits, caches = _pair_logits(src, dst, row, eid, w, shape, None)
    return logits, row, caches


def sellers(row: np.ndarray) -> np.ndarray:
    """Marks the first slot of each row."""
    return np.diff(row, prepend=-1) != 0


def loss_and_slope(logits: np.ndarray, row: np.ndarray, loss: str) -> tuple[float, float, np.ndarray]:
    """(summed loss, number of terms, d sum / d logits)."""
    first = sellers(row)
    if loss == "binary_cross_entropy":
        terms = np.maximum(logits, 0.0) - logits * first + np.log1p(np.exp(-np.abs(logits)))
        return float(terms.sum()), float(len(terms)), _sigmoid(logits) - first
    strength = _sigmoid(logits)
    gap = np.where(first, 0.0, strength - strength[first][row] + 1.0)
    active = (gap > 0).astype(float)
    pull = np.where(first, -np.bincount(row, active)[row] if len(row) else 0.0, active)
    return float(gap[gap > 0].sum()), float((~first).sum()), pull * strength * (1.0 - strength)


def pair_gradient(
    src: np.ndarray, dst: np.ndarray, row: np.ndarray, eid: np.ndarray | None, w: dict, shape: Shape, loss: str,
    width: int | None = None,
) -> tuple[float, float, dict]:
    """(summed loss, number of terms, summed gradient per weight) of the blocks of purchasers and of their slots."""
    logits, (h_src, c_src, h_dst, c_dst) = _pair_logits(src, dst, row, eid, w, shape, width)
    total, terms, d_dst = loss_and_slope(logits, row, loss)
    d_src = np.bincount(row, d_dst, minlength=len(src))
    g = {name: np.zeros_like(value) for name, value in w.items()}
    half = h_src.shape[1]
    g["score.w"][:half] = h_src.T @ d_src
    g["score.w"][half:] = h_dst.T @ d_dst
    g["score.b"][0] = d_dst.sum()
    _encode_back(w, g, d_src[:, None] * w["score.w"][:half], c_src)
    _encode_back(w, g, d_dst[:, None] * w["score.w"][half:], c_dst)
    return total, terms, g


def batch_gradient(
    batch: pa.RecordBatch, w: dict, shape: Shape, loss: str, exclude: bool
) -> tuple[float, float, dict]:
    """(summed loss, number of terms, summed gradient per weight)."""
    return pair_gradient(*_pairs(batch, shape, exclude), w, shape, loss)
