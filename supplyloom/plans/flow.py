"""Loss and gradient of a step over a table of companies, each encoded once a step.

``gradient.py`` reads an own block for each slot of each edge. Here a task holds a table of companies with their sampled
neighbours as places in it, and a step encodes every distinct company that it meets once per layer, whatever number of
slots and neighbourhoods it stands in. Only where an edge to leave out is among the sampled ones of a company, that
company is encoded once more for this edge. The sums are the same but for their order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from supplyloom.plans.examples import NO_EDGE
from supplyloom.plans.gradient import loss_and_slope

#: Stands for "leaves out no edge".
KEEP_ALL = -2


@dataclass(frozen=True)
class Companies:
    """``x`` [v, width]; per layer the places of the sampled neighbours and the edges that brought them [v, fanout]."""

    x: np.ndarray
    near: tuple[np.ndarray, np.ndarray]
    via: tuple[np.ndarray, np.ndarray]


def _added(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Sums the rows of ``values`` [k, d] by their place ``at`` [k] among ``n``."""
    order = np.argsort(at, kind="stable")
    places, starts = np.unique(at[order], return_index=True)
    out = np.zeros((n, values.shape[1]))
    if len(places):
        out[places] = np.add.reduceat(values[order], starts, axis=0)
    return out


def _layer(w: dict, name: str, x: np.ndarray, own: np.ndarray, near: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, tuple]:
    """``x`` [v, d], rows ``own`` [n] and ``near`` [n, f] of it -> output and what backward needs."""
    if f"{name}.w_pool" in w:
        pooled = np.maximum(x @ w[f"{name}.w_pool"].T + w[f"{name}.b_pool"], 0.0)[near] * mask[..., None]
        best = pooled.argmax(axis=1)
        agg = np.take_along_axis(pooled, best[:, None, :], axis=1)[:, 0, :]
        kept = best
    else:
        kept = mask / np.maximum(mask.sum(axis=1, keepdims=True), 1.0)
        agg = np.einsum("nf,nfd->nd", kept, x[near])
    out = x[own] @ w[f"{name}.w_self"].T + agg @ w[f"{name}.w_neigh"].T + w[f"{name}.bias"]
    return out, (x, own, near, agg, kept)


def _layer_back(w: dict, g: dict, name: str, d_out: np.ndarray, cache: tuple, down: bool) -> np.ndarray | None:
    """Sets the weight gradients in ``g``; returns that of ``x`` if it is to go further ``down``."""
    x, own, near, agg, kept = cache
    g[f"{name}.w_self"] = d_out.T @ x[own]
    g[f"{name}.w_neigh"] = d_out.T @ agg
    g[f"{name}.bias"] = d_out.sum(axis=0)
    d_agg = d_out @ w[f"{name}.w_neigh"]
    d_x = _added(d_out @ w[f"{name}.w_self"], own, len(x)) if down else None
    if f"{name}.w_pool" in w:
        width = x.shape[1]
        # Neither rectified nor masked entries pass a gradient.
        places = np.take_along_axis(near, kept, axis=1) * width + np.arange(width)
        d_pool = np.bincount(places.ravel(), (d_agg * (agg > 0)).ravel(), minlength=x.size).reshape(x.shape)
        g[f"{name}.w_pool"] = d_pool.T @ x
        g[f"{name}.b_pool"] = d_pool.sum(axis=0)
        return d_x + d_pool @ w[f"{name}.w_pool"] if down else None
    if down:
        for k in range(near.shape[1]):
            d_x += _added(kept[:, k, None] * d_agg, near[:, k], len(x))
    return d_x


def _distinct(key: np.ndarray, node: np.ndarray, drop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    _, first, at = np.unique(key, return_index=True, return_inverse=True)
    return node.ravel()[first], drop.ravel()[first], at.reshape(key.shape)


def _masks(via: np.ndarray, node: np.ndarray, drop: np.ndarray) -> np.ndarray:
    edges = via[node]
    return ((edges != NO_EDGE) & (edges != drop[:, None])).astype(float)


def _encoded(table: Companies, top: np.ndarray, top_out: np.ndarray, w: dict) -> tuple[np.ndarray, np.ndarray, tuple, tuple]:
    """Embeddings of the companies ``top``, each leaving out the edge ``top_out``, and what backward needs."""
    (near1, near2), (via1, via2), v = table.near, table.via, len(table.x)
    # The companies whose first layer is needed: those on top, and their neighbours.
    seen = np.concatenate([top[:, None], near2[top]], axis=1)
    seen_out = np.broadcast_to(top_out[:, None], seen.shape)
    met = (via1[seen] == seen_out[..., None]).any(axis=2)
    key = np.where(met, v + np.arange(len(top))[:, None] * v + seen, seen)
    mid, mid_out, at_mid = _distinct(key, seen, np.where(met, seen_out, KEEP_ALL))

    raw, at_raw = np.unique(np.concatenate([mid[:, None], near1[mid]], axis=1), return_inverse=True)
    at_raw = at_raw.reshape(len(mid), -1)
    x = table.x[raw].astype(float, copy=False)
    z, cache1 = _layer(w, "layer1", x, at_raw[:, 0], at_raw[:, 1:], _masks(via1, mid, mid_out))
    h, cache2 = _layer(w, "layer2", np.maximum(z, 0.0), at_mid[:, 0], at_mid[:, 1:], _masks(via2, top, top_out))
    return h, z, cache1, cache2


def embeddings(table: Companies, nodes: np.ndarray, w: dict) -> np.ndarray:
    """Embeddings of the companies ``nodes`` [n] with all their sampled neighbours."""
    return _encoded(table, nodes, np.full(len(nodes), KEEP_ALL), w)[0]


def step_gradient(
    table: Companies, src: np.ndarray, dst: np.ndarray, row: np.ndarray, eid: np.ndarray | None, w: dict, loss: str
) -> tuple[float, float, dict]:
    """(summed loss, number of terms, summed gradient per weight) of edges with their slots.

    ``src`` [n]: places of the purchasers; ``dst`` [m]: those of the slots, of the edges ``row`` [m].
    """
    (near1, near2), (via1, via2), v = table.near, table.via, len(table.x)
    node, owner = np.concatenate([src, dst]), np.concatenate([np.arange(len(src)), row])
    if eid is None:
        out = np.full(len(node), KEEP_ALL)
        key = node
    else:
        # An edge to leave out matters to the companies in whose sampled neighbourhood it is.
        out = eid[owner]
        met = (via2[node] == out[:, None]).any(axis=1) | (via1[node] == out[:, None]).any(axis=1)
        for k in range(near2.shape[1]):
            met |= (via1[near2[node, k]] == out[:, None]).any(axis=1)
        key, out = np.where(met, v + owner * v + node, node), np.where(met, out, KEEP_ALL)
    top, top_out, at_top = _distinct(key, node, out)

    h, z, cache1, cache2 = _encoded(table, top, top_out, w)
    half = h.shape[1]
    at_src, at_dst = at_top[: len(src)], at_top[len(src) :]
    logits = (h @ w["score.w"][:half])[at_src][row] + (h @ w["score.w"][half:])[at_dst] + w["score.b"][0]
    total, terms, slope = loss_and_slope(logits, row, loss)
    as_buyer = np.bincount(at_src, np.bincount(row, slope, minlength=len(src)), minlength=len(h))
    as_seller = np.bincount(at_dst, slope, minlength=len(h))
    g = {"score.w": np.concatenate([h.T @ as_buyer, h.T @ as_seller]), "score.b": np.array([slope.sum()])}
    d_h = as_buyer[:, None] * w["score.w"][:half] + as_seller[:, None] * w["score.w"][half:]
    d_mid = _layer_back(w, g, "layer2", d_h, cache2, down=True)
    _layer_back(w, g, "layer1", d_mid * (z > 0), cache1, down=False)
    return total, terms, {name: g[name] for name in w}
