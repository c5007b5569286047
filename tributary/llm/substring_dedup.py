"""Substring dedup with suffix automata over reference shards.

Words that lie in a run of ``min_words`` words which also starts in a document with a smaller id are removed.

The automata of all documents cannot be broadcast: they grow with the corpus. So only text that can repeat enters
an automaton, each automaton covers one shard of it, and a piece of a document goes only to the shard that can
hold a copy:

1. Each window of ``min_words`` words is keyed by the smallest hash of its ``ANCHOR``-word runs (a minimizer).
   Equal windows have equal keys, and neighbouring windows mostly share one, so a block of documents asks about few
   keys: which of them stand in two documents? Keys travel as packed arrays by hash range; the answers come back by block.
2. Runs of windows with a repeated key become pieces, cut so that the first and the last window cover one. Equal pieces
   of a block collapse to their smallest and largest document id. Pieces go to the shard of their key; pieces of
   very common keys are cut to single windows and go by the hash of the window, which spreads them.
3. A shard streams its distinct pieces, by ascending smallest id, through the suffix automaton of those
   before. Where the matching statistic reaches ``min_words``, an earlier document holds the window.
4. Each block gets back its repeated windows, and unites the covered words into maximal spans.

The shard's pieces are compared as sequences of 64-bit word hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tributary.llm.blocks import blocked, bucket_count
from tributary.llm.words import U, full_grams, gram_hashes, mix, range_index, split_words, steps

MIN_WORDS = 13
ANCHOR = 5
#: A key that stands in more blocks is routed by windows.
COMMON_BLOCKS = 64
#: Words in one automaton (about 600 bytes of memory each); a key is never cut.
AUTOMATON_WORDS = 60_000


class SuffixAutomaton:
    """Generalised suffix automaton over sequences of integers; add() extends it, match() streams over it.

    Each state knows the owner of the sequence in which its strings were first seen.
    """

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.owner = [-1], [0], [None]

    def _clone(self, p: int, c: int, q: int) -> int:
        nexts, link, length = self.next, self.link, self.length
        made = len(nexts)
        nexts.append(nexts[q].copy())
        length.append(length[p] + 1)
        link.append(link[q])
        self.owner.append(self.owner[q])
        link[q] = made
        while p >= 0 and nexts[p].get(c) == q:
            nexts[p][c] = made
            p = link[p]
        return made

    def add(self, sequence, owner=None) -> None:
        nexts, link, length, owners = self.next, self.link, self.length, self.owner
        last = 0
        for c in sequence:
            q = nexts[last].get(c)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._clone(last, c, q)
                continue
            made = len(nexts)
            nexts.append({})
            length.append(length[last] + 1)
            link.append(0)
            owners.append(owner)
            p = last
            while p >= 0 and c not in nexts[p]:
                nexts[p][c] = made
                p = link[p]
            if p >= 0:
                q = nexts[p][c]
                link[made] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
            last = made

    def match(self, sequence, window: int = 0) -> tuple[list[int], list]:
        """Matching statistics: length of the longest suffix of each prefix that the automaton holds.

        With a window, also the first owner of the last ``window`` items, None where the automaton lacks them.
        """
        nexts, link, length = self.next, self.link, self.length
        state = size = 0
        sizes, owners = [], []
        for c in sequence:
            while state and c not in nexts[state]:
                state = link[state]
                size = length[state]
            to = nexts[state].get(c)
            if to is None:
                size = 0
            else:
                state, size = to, size + 1
            sizes.append(size)
            if window:
                at = state if size >= window else None
                while at and length[link[at]] >= window:
                    at = link[at]
                owners.append(None if at is None else self.owner[at])
        return sizes, owners


def _windows(words, hashes: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First word of each window that lies in one text, and the window's minimizer."""
    whole = full_grams(words.text, min_words)
    grams = gram_hashes(hashes, ANCHOR)
    span = min_words - ANCHOR + 1
    low, width = grams, 1
    while 2 * width <= span:
        low, width = np.minimum(low[: len(low) - width], low[width:]), 2 * width
    if width < span:
        low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
    at = np.flatnonzero(whole)
    return at, low[at]


def _new_run(at: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Where a window does not continue the run of its key."""
    first = np.ones(len(at), bool)
    first[1:] = (key[1:] != key[:-1]) | (at[1:] != at[:-1] + 1)
    return first


def _ids(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    known = table["doc_id"].is_valid().to_numpy()
    return table["doc_id"].fill_null(0).to_numpy().astype(np.int64), known


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    """Rising with the key, so keys in order are buckets in order."""
    return (((key >> U(32)) * U(buckets)) >> U(32)).astype(np.int64)


def _cut(sorted_bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, from, to) of the runs of a sorted array."""
    first = np.flatnonzero(np.concatenate([[True], sorted_bucket[1:] != sorted_bucket[:-1]])) if len(sorted_bucket) else np.zeros(0, np.int64)
    return sorted_bucket[first], first, np.append(first[1:], len(sorted_bucket)).astype(np.int64)


def _questions(min_words: int, buckets: int):
    """Keys of a block by hash range, each once, and whether two documents of the block hold it."""

    def run(table: pa.Table) -> pa.Table:
        keys, docs = [], []
        for part in steps(table, "text"):
            words = split_words(part["text"])
            at, key = _windows(words, words.hashes(), min_words)
            ids, known = _ids(part)
            first = _new_run(at, key) & known[words.text[at]]
            keys.append(key[first])
            docs.append(ids[words.text[at[first]]])
        key, doc = np.concatenate(keys), np.concatenate(docs)
        order = np.argsort(key)
        key, doc = key[order], doc[order]
        one, first, _ = _cut(key)
        many = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first) if len(one) else np.zeros(0, bool)
        bucket, lo, hi = _cut(_bucket(one, buckets))
        block = table["block"][0].as_py()
        return pa.table({
            "bucket": pa.array(bucket, pa.int32()), "block": pa.array([block] * len(bucket), pa.int32()),
            "keys": pa.array([one[a:b].tobytes() for a, b in zip(lo, hi)], pa.binary()),
            "many": pa.array([many[a:b].tobytes() for a, b in zip(lo, hi)], pa.binary()),
        })

    return run


def _answer(table: pa.Table) -> pa.Table:
    """Per block, which of its keys stand in two documents, and which of these in many blocks."""
    asked = [np.frombuffer(x, U) for x in table["keys"].to_pylist()]
    key = np.concatenate(asked)
    many = np.frombuffer(b"".join(table["many"].to_pylist()), bool)
    order = np.argsort(key)
    one, lo, hi = _cut(key[order])
    repeated = (hi - lo > 1) | np.logical_or.reduceat(many[order], lo)
    state = np.empty(len(key), np.int8)
    state[order] = np.repeat(repeated * (1 + (hi - lo > COMMON_BLOCKS)), hi - lo)
    ends = np.cumsum([len(x) for x in asked])
    per_block = [(x, s) for x, s in zip(asked, np.split(state, ends[:-1]))]
    return pa.table({
        "block": table["block"].combine_chunks(),
        "plain": pa.array([x[s == 1].tobytes() for x, s in per_block], pa.binary()),
        "common": pa.array([x[s == 2].tobytes() for x, s in per_block], pa.binary()),
    })


def _found(sorted_keys: np.ndarray, key: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(key), bool)
    return sorted_keys[np.minimum(np.searchsorted(sorted_keys, key), len(sorted_keys) - 1)] == key


def _coded(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words, and each word as its place among them: neighbouring pieces share most words."""
    distinct, code = np.unique(words, return_inverse=True)
    return distinct, code.astype(np.uint16 if len(distinct) < 1 << 16 else np.uint32)


def _decoded(distinct: bytes, codes: bytes, n: int) -> np.ndarray:
    return np.frombuffer(distinct, U)[np.frombuffer(codes, np.uint16 if len(codes) == 2 * n else np.uint32)]


def _pieces(min_words: int, buckets: int):
    """Distinct repeated pieces of a block, by shard."""
    span = min_words - ANCHOR + 1

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        plain, common = (np.sort(np.frombuffer(b"".join(answers[c].to_pylist()), U)) for c in ("plain", "common"))
        route, content, size, lo_doc, text_words = [], [], [], [], []
        for part in steps(docs, "text") if len(docs) and len(plain) + len(common) else ():
            words = split_words(part["text"])
            hashes = words.hashes()
            at, key = _windows(words, hashes, min_words)
            ids, known = _ids(part)
            mine = known[words.text[at]]
            at, key = at[mine], key[mine]
            window = gram_hashes(hashes, min_words, 1)
            run_start = np.flatnonzero(_new_run(at, key))
            run_size = np.diff(np.append(run_start, len(at)))
            usual = _found(plain, key[run_start])
            # A run of windows, in pieces of at most ``span`` windows.
            start, length = run_start[usual], run_size[usual]
            n_cuts = -(-length // span)
            cut = range_index(np.zeros(len(start), np.int64), n_cuts)
            first = np.repeat(start, n_cuts) + cut * span
            count = np.minimum(span, np.repeat(length, n_cuts) - cut * span)
            # Windows of common keys one by one.
            single = range_index(run_start, np.where(_found(common, key[run_start]), run_size, 0))
            first, count = np.concatenate([first, single]), np.concatenate([count, np.ones(len(single), np.int64)])
            whole = window[at[first]]
            name = mix(whole * U(3) + window[at[first + count - 1]] * U(5) + count.astype(U))
            to = np.concatenate([key[first[: len(cut)]], whole[len(cut) :]])
            doc = ids[words.text[at[first]]]
            # One row for each content of the step.
            order = np.lexsort((doc, name))
            keep = order[np.concatenate([[True], name[order][1:] != name[order][:-1]])] if len(order) else order
            last = order[np.concatenate([name[order][1:] != name[order][:-1], [True]])] if len(order) else order
            n_words = count[keep] + min_words - 1
            text_words.append(hashes[range_index(at[first[keep]], n_words)])
            route.append(to[keep]), content.append(name[keep]), size.append(n_words), lo_doc.append(np.stack([doc[keep], doc[last]]))
        if not route:
            return _PIECES.empty_table()
        route, content, size = map(np.concatenate, (route, content, size))
        lo_doc, text_words = np.concatenate(lo_doc, axis=1), np.concatenate(text_words)
        where = np.cumsum(size) - size
        # One row for each content of the block, by route.
        order = np.lexsort((content, route))
        name, first, _ = _cut(content[order])
        low = np.minimum.reduceat(lo_doc[0][order], first) if len(first) else first
        high = np.maximum.reduceat(lo_doc[1][order], first) if len(first) else first
        keep = order[first]
        bucket, a, b = _cut(_bucket(route[keep], buckets))
        n = size[keep]
        word_ends = np.concatenate([[0], np.cumsum(n)])
        flat = text_words[range_index(where[keep], n)]
        coded = [_coded(flat[word_ends[i] : word_ends[j]]) for i, j in zip(a, b)]
        return pa.table({
            "bucket": pa.array(bucket, pa.int32()), "block": pa.array([docs["block"][0].as_py()] * len(bucket), pa.int32()),
            "route": [route[keep][i:j].tobytes() for i, j in zip(a, b)], "name": [name[i:j].tobytes() for i, j in zip(a, b)],
            "size": [n[i:j].astype(np.int32).tobytes() for i, j in zip(a, b)], "words": [x.tobytes() for x, _ in coded], "codes": [x.tobytes() for _, x in coded],
            "low": [low[i:j].tobytes() for i, j in zip(a, b)], "high": [high[i:j].tobytes() for i, j in zip(a, b)],
        }, schema=_PIECES)

    return run


_PIECES = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), *((c, pa.binary()) for c in ("route", "name", "size", "words", "codes", "low", "high"))])


def _first_holders(pieces: list[list[int]], low: list[int], min_words: int) -> list[list[int]]:
    """For each piece, by ascending document id, the smallest id of a document that holds each of its windows."""
    automaton, out, at = SuffixAutomaton(), [], 0
    while at < len(pieces):
        stop = at
        while stop < len(pieces) and low[stop] == low[at]:  # of one document: none is a reference for another
            owners = automaton.match(pieces[stop], min_words)[1][min_words - 1 :]
            out.append([low[at] if x is None else x for x in owners])
            stop += 1
        for piece in pieces[at:stop]:
            automaton.add(piece, low[at])
        at = stop
    return out


def _shard(min_words: int):
    """Per block, its windows that an earlier document may cover, with the smallest id known to hold each."""

    def column(table: pa.Table, name: str, kind) -> np.ndarray:
        return np.frombuffer(b"".join(table[name].to_pylist()), kind)

    def run(table: pa.Table) -> pa.Table:
        route, name, low, high = column(table, "route", U), column(table, "name", U), column(table, "low", np.int64), column(table, "high", np.int64)
        size = column(table, "size", np.int32).astype(np.int64)
        in_row = [int(np.frombuffer(x, np.int32).sum()) for x in table["size"].to_pylist()]
        words = np.concatenate([_decoded(*x) for x in zip(table["words"].to_pylist(), table["codes"].to_pylist(), in_row)])
        counts = [len(x) // 8 for x in table["name"].to_pylist()]
        row = np.repeat(np.arange(len(counts)), counts)
        where = np.cumsum(size) - size
        order = np.lexsort((name, route))
        _, first, last = _cut(name[order])
        keep = order[first]  # distinct pieces, by route
        least = np.minimum.reduceat(low[order], first)
        holders: list[list[int]] = [None] * len(keep)
        route_end = np.flatnonzero(np.append(route[keep][1:] != route[keep][:-1], True)) + 1
        word_end = np.cumsum(size[keep])
        at = 0
        while at < len(keep):
            fits = np.searchsorted(word_end, (word_end[at - 1] if at else 0) + AUTOMATON_WORDS, side="right")
            i = max(np.searchsorted(route_end, at, side="right"), np.searchsorted(route_end, fits, side="right") - 1)
            stop = int(route_end[i])
            by_doc = at + np.argsort(least[at:stop], kind="stable")
            flat = words[range_index(where[keep[by_doc]], size[keep[by_doc]])]
            symbols = np.unique(flat, return_inverse=True)[1].tolist()
            ends = np.cumsum(size[keep[by_doc]]).tolist()
            pieces = [symbols[e - n : e] for e, n in zip(ends, size[keep[by_doc]].tolist())]
            for j, of_piece in zip(by_doc.tolist(), _first_holders(pieces, least[by_doc].tolist(), min_words)):
                holders[j] = of_piece
            at = stop
        # Windows of the distinct pieces: hash and first holder.
        n_windows = size[keep] - min_words + 1
        grams = gram_hashes(words, min_words, 1)
        window = grams[range_index(where[keep], n_windows)]
        below = np.array([x for of_piece in holders for x in of_piece], np.int64)
        window_at = np.cumsum(n_windows) - n_windows
        piece = np.empty(len(name), np.int64)
        piece[order] = np.repeat(np.arange(len(keep)), last - first)
        # Back to the blocks: only windows that some document of the block loses.
        by_row = np.argsort(row, kind="stable")
        idx = range_index(window_at[piece[by_row]], n_windows[piece[by_row]])
        owner = np.repeat(by_row, n_windows[piece[by_row]])
        lost = below[idx] < high[owner]
        idx, to = idx[lost], row[owner[lost]]
        rows, a, b = _cut(to)
        return pa.table({
            "block": table["block"].combine_chunks().take(pa.array(rows)),
            "window": pa.array([window[idx[i:j]].tobytes() for i, j in zip(a, b)], pa.binary()),
            "below": pa.array([below[idx[i:j]].tobytes() for i, j in zip(a, b)], pa.binary()),
        })

    return run


_KEPT = pa.schema([("doc_id", pa.int64()), ("kept_text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())])


def _remove(min_words: int):
    def run(docs: pa.Table, covered: pa.Table) -> pa.Table:
        window = np.frombuffer(b"".join(covered["window"].to_pylist()), U)
        below = np.frombuffer(b"".join(covered["below"].to_pylist()), np.int64)
        order = np.argsort(window)
        window, first, _ = _cut(window[order])
        below = np.minimum.reduceat(below[order], first) if len(first) else below
        out = []
        for part in steps(docs, "text") if len(docs) else ():
            words = split_words(part["text"])
            ids, known = _ids(part)
            gone = np.zeros(len(words.start) + 1, np.int64)
            at = np.flatnonzero(full_grams(words.text, min_words)) if len(window) else np.zeros(0, np.int64)
            if len(at):
                found = gram_hashes(words.hashes(), min_words, 1)[at]
                place = np.minimum(np.searchsorted(window, found), len(window) - 1)
                doc = words.text[at]
                hit = at[(window[place] == found) & known[doc] & (below[place] < ids[doc])]
                gone[hit] += 1
                np.subtract.at(gone, hit + min_words, 1)
            removed = np.cumsum(gone)[:-1] > 0
            opens = removed & np.concatenate([[True], ~removed[:-1] | (words.text[1:] != words.text[:-1])])[: len(removed)]
            count = lambda which: np.bincount(words.text[which], minlength=words.n_texts)  # noqa: E731, B023
            out.append(pa.table([part["doc_id"].combine_chunks(), words.joined(~removed).cast(pa.string()), words.per_text, count(removed), count(opens)], schema=_KEPT))
        return pa.concat_tables(out) if out else _KEPT.empty_table()

    return run


def remove_repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Each row's text without the spans that documents with a smaller id hold too.

    Returns doc_id, kept_text (kept words joined by one space), n_words, n_removed, n_spans (maximal removed spans), one
    row per row of ``docs``. A null or blank text has no words and gives an empty kept_text. Rows with a null id are
    neither references nor changed. Rows that repeat an id count as one document and so keep their common spans. Other columns
    are ignored; an empty table gives no rows. A block's texts are held whole by one task.
    """
    if min_words < ANCHOR:
        raise ValueError(f"min_words must be at least {ANCHOR}")
    base, blocks = blocked(docs, id_col, text_col)
    buckets = bucket_count(docs, blocks)
    by_block = base.groupBy("block")
    questions = by_block.applyInArrow(_questions(min_words, buckets), "bucket int, block int, keys binary, many binary")
    answers = questions.groupBy("bucket").applyInArrow(_answer, "block int, plain binary, common binary")
    pieces = by_block.cogroup(answers.groupBy("block")).applyInArrow(
        _pieces(min_words, buckets), "bucket int, block int, route binary, name binary, size binary, words binary, codes binary, low binary, high binary"
    )
    covered = pieces.groupBy("bucket").applyInArrow(_shard(min_words), "block int, window binary, below binary")
    return by_block.cogroup(covered.groupBy("block")).applyInArrow(
        _remove(min_words), "doc_id bigint, kept_text string, n_words bigint, n_removed bigint, n_spans bigint"
    )
