"""Contracts word by word, for tests."""

import hashlib
import re


def decontaminated(docs: list[tuple], items: list[tuple], n: int = 10) -> dict:
    """{doc_id: (n_words, n_hit, n_items, sha, contaminated)}."""
    norm = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = []
    for item_id, text in items:
        w = norm(text)
        size = min(n, len(w))
        windows += [(str(item_id), tuple(w[i : i + size])) for i in range(len(w) - size + 1) if size]
    out = {}
    for doc_id, text in docs:
        w = norm(text)
        hit, ids = set(), set()
        for item_id, win in windows:
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    ids.add(item_id)
        out[doc_id] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit))
    return out
