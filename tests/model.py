"""Event-by-event scorer, the model the distributed one is compared with."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict


class SequentialScorer:
    """Keeps one counter per entity, or ``depth`` cells per entity when a config asks for a sketch."""

    def __init__(self, cfg):
        self.cfg = cfg
        self.current = defaultdict(int)
        self.total = defaultdict(int)
        self.tick = 0
        self.start = None

    def _cells(self, src, dst):
        names = ("edge", "src", "dst")
        keys = (f"{src}→{dst}", src, dst)
        if self.cfg.counts == "exact":
            return {n: [(n, k)] for n, k in zip(names, keys)}
        cells = {}
        for i, (name, key) in enumerate(zip(names, keys)):
            rows = range(i * self.cfg.depth, (i + 1) * self.cfg.depth)
            cells[name] = [(r, self._hash(r, key)) for r in rows]
        return cells

    def _hash(self, row, key):
        digest = hashlib.md5(f"{self.cfg.seed + row}:{key}".encode()).hexdigest()
        return int(digest[:15], 16) % self.cfg.width

    def _decay(self):
        for k, v in self.current.items():
            decayed = v * self.cfg.alpha
            self.current[k] = math.floor(decayed) if self.cfg.decay == "floor" else decayed

    def score(self, src, dst, timestamp):
        if self.start is None:
            self.start = timestamp
        tick = max(1, max(0, timestamp - self.start) // self.cfg.tick_seconds + 1)
        if tick > self.tick:
            if self.tick:
                self._decay()
            self.tick = tick
        cells = self._cells(src, dst)
        out = {"tick": tick}
        for name in cells:
            for c in cells[name]:
                self.current[c] += 1
                self.total[c] += 1
        for name in cells:
            a = min(self.current[c] for c in cells[name])
            s = min(self.total[c] for c in cells[name])
            out[f"{name}_current"], out[f"{name}_total"] = a, s
            gap = a - s / tick
            out[f"{name}_score"] = (
                gap * gap * tick * tick / (s * (tick - 1)) if s > 0 and tick > 1 and a > 0 else 0.0
            )
        out["score"] = max(out["edge_score"], out["src_score"], out["dst_score"])
        out["expected_edge"] = out["edge_total"] / tick
        if self.cfg.filter_anomalies and out["score"] > self.cfg.filter_cutoff:
            for name in cells:
                for c in cells[name]:
                    self.total[c] -= 1
        return out


def score_all(rows, cfg):
    """``{event_id: result}`` for rows ``(src, dst, timestamp, event_id)`` in stream order."""
    order = (lambda r: (r[2], r[3])) if cfg.order == "event_time" else (lambda r: r[3])
    scorer = SequentialScorer(cfg)
    return {r[3]: scorer.score(r[0], r[1], r[2]) for r in sorted(rows, key=order)}
