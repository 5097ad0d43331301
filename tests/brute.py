"""Plain NumPy counterparts for small inputs."""

import hashlib

import numpy as np


def draw(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def layer(x, edges, w, aggregator="mean", rectify=False):
    """x: {id: vector}, edges: [(src, dst)] -> {id: vector}"""
    out = {}
    for v, own in x.items():
        near = [x[s] for s, d in edges if d == v]
        if aggregator == "pool":
            near = [np.maximum(w.w_pool @ n + w.b_pool, 0) for n in near]
        if not near:
            agg = np.zeros(w.width_in)
        else:
            agg = np.mean(near, axis=0) if aggregator == "mean" else np.max(near, axis=0)
        z = w.w_self @ own + w.w_neigh @ agg + w.bias
        out[v] = np.maximum(z, 0) if rectify else z
    return out


def embed(x, edges, model, edges2=None, final_relu=False):
    h1 = layer(x, edges, model.layer1, model.aggregator, True)
    return layer(h1, edges if edges2 is None else edges2, model.layer2, model.aggregator, final_relu)


def auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y]
    neg = [s for s, y in zip(scores, labels) if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def average_precision(scores, labels):
    total, out, seen = sum(labels), 0.0, 0.0
    for t in sorted(set(scores), reverse=True):
        tp = sum(1 for s, y in zip(scores, labels) if s >= t and y)
        out += (tp - seen) / total * tp / sum(1 for s in scores if s >= t)
        seen = tp
    return out
