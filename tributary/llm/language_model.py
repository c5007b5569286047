"""Hashed maximum-entropy language model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class, history). The classes are the most frequent tokens, each alone, and classes by
the last two bytes of a word. The first factor is a softmax over the sum of five weight rows, found by hash:
bias, previous word, the classes of the two words before, the word before the previous one (skip), and the classes of the second and
third word back (skip). The second factor is a softmax over the words of the class. Each word has a feature of its own, whose maximum-likelihood
weight is known: its count in the class plus one, where one more count is left to all words never seen. The ``FREQUENT`` most frequent
words without a class of their own, of at least ``CUTOFF`` training tokens, also have one feature for each hashed previous word. The words without such
features share what is left, so the sum over a class needs only the frequent ones, and the gradient of these features only the counts of (previous word, word).

Token counts cover every training text: blocks of documents ask by hash range for the totals of their distinct words and get them back
in the order asked. Gradients cover every training text too, in ``STEPS`` steps over disjoint parts: each task sums the gradient
of its tokens, the sums of all tasks are added by feature range, and the driver takes the fixed-size result (``ROWS`` x ``CLASSES`` numbers)
for one update scaled by its diagonal. The same tasks count the pairs of previous word and frequent word (``WORD_ROWS`` x ``FREQUENT`` numbers), which the driver
fits in ``FITS`` updates. Texts are scored in numpy batches of ``CHUNK`` tokens.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.blocks import blocked, bucket_count
from tributary.llm.words import LOWER, U, Words, mix, split_words, steps
from tributary.session import scratch_path

CLASSES = 32
#: Classes of one token each; the end of text is the first.
ALONE = 8
WORD_ROWS, PAIR_ROWS = 2048, CLASSES * CLASSES
ROWS = 1 + 2 * WORD_ROWS + 2 * PAIR_ROWS
STEPS = 4
RATES = (0.5, 0.4, 0.3, 0.3)
SMOOTHING = 5.0
#: Words with features of their history, and the training tokens they need; updates of these features.
FREQUENT, CUTOFF, FITS = 512, 256, 12
CHUNK = 1 << 14
PARTS = 8
BLOCK_BYTES = 12 << 20
END = U(0x5851F42D4C957F2D)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows the model does not learn from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 7 == 2, F.lit(False))


@dataclass
class Tokens:
    """Tokens of the texts of one step: words and an end for each text."""

    hashes: np.ndarray
    kind: np.ndarray  # class by form; 0 for the end
    text: np.ndarray
    place: np.ndarray  # in the text
    per_text: np.ndarray


def _form_class(words: Words) -> np.ndarray:
    """Class of each word by its last two bytes."""
    last = words.data[words.end - 1].astype(U)
    before = np.where(words.end - words.start > 1, words.data[np.maximum(words.end - 2, 0)], 0).astype(U)
    return (ALONE + (mix(last * U(256) + before) % U(CLASSES - ALONE)).astype(np.int64)).astype(np.uint8)


def tokenize(texts) -> Tokens:
    words = split_words(texts, LOWER)
    per_text = words.per_text + 1
    n = len(words.text) + words.n_texts
    at = np.arange(len(words.text)) + words.text  # one end for each text before
    hashes, kind = np.full(n, END, U), np.zeros(n, np.uint8)
    hashes[at], kind[at] = words.hashes(), _form_class(words)
    text = np.repeat(np.arange(words.n_texts), per_text)
    return Tokens(hashes, kind, text, np.arange(n) - np.repeat(np.cumsum(per_text) - per_text, per_text), per_text)


def _distinct(keys: list[np.ndarray], counts: list[np.ndarray], kinds: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key = np.concatenate(keys)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    total = np.add.reduceat(np.concatenate(counts)[order], first) if len(first) else np.zeros(0, np.int64)
    return key[first], total, np.concatenate(kinds)[order][first]


def _block_words(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct tokens of a block, in order of their hash: training count and class by form."""
    keys, counts, kinds = [], [], []
    for part in steps(table, "text"):
        tokens = tokenize(part["text"])
        learnt = part["train"].to_numpy()[tokens.text]
        key, first, inverse = np.unique(tokens.hashes, return_index=True, return_inverse=True)
        keys.append(key), kinds.append(tokens.kind[first]), counts.append(np.bincount(inverse, weights=learnt, minlength=len(key)).astype(np.int64))
    return _distinct(keys, counts, kinds)


def _bucket_cuts(key: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of hash ranges that a sorted array reaches, and where they start (one more at the end)."""
    bucket = (((key >> U(32)) * U(buckets)) >> U(32)).astype(np.int64)
    found, first = np.unique(bucket, return_index=True)
    return found, np.append(first, len(key))


def _ask(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        key, count, kind = _block_words(table)
        found, at = _bucket_cuts(key, buckets)
        cut = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary())
        block = pa.array([table["block"][0].as_py()] * len(found), pa.int32())
        return pa.table({"bucket": pa.array(found, pa.int32()), "block": block, "keys": cut(key), "counts": cut(count.astype(np.uint32)), "kinds": cut(kind)})

    return run


_ANSWER = pa.schema([
    ("bucket", pa.int32()), ("block", pa.int32()), ("totals", pa.binary()), ("tokens", pa.binary()), ("types", pa.binary()),
    ("top", pa.list_(pa.struct([("n", pa.int64()), ("key", pa.int64()), ("kind", pa.int32())]))),
])


def _answer(table: pa.Table) -> pa.Table:
    """Totals of the asked words, per block in its order. The first row also has the bucket's tokens and types by class, and its most
    frequent words."""
    asked = [np.frombuffer(x, U) for x in table["keys"].to_pylist()]
    counts = np.frombuffer(b"".join(table["counts"].to_pylist()), np.uint32).astype(np.int64)
    kinds = np.frombuffer(b"".join(table["kinds"].to_pylist()), np.uint8)
    key, inverse = np.unique(np.concatenate(asked), return_inverse=True)
    total = np.bincount(inverse, weights=counts, minlength=len(key)).astype(np.int64)
    kind = np.zeros(len(key), np.uint8)
    kind[inverse] = kinds
    per_block = np.split(total[inverse], np.cumsum([len(x) for x in asked])[:-1])
    tokens = np.bincount(kind, weights=total, minlength=CLASSES).astype(np.int64)
    types = np.bincount(kind, weights=total > 0, minlength=CLASSES).astype(np.int64)
    most = np.argsort(-total, kind="stable")[: ALONE + FREQUENT]
    top = [{"n": int(total[i]), "key": int(key[i].astype(np.int64)), "kind": int(kind[i])} for i in most]
    rest = len(asked) - 1
    return pa.table({
        "bucket": table["bucket"].combine_chunks(), "block": table["block"].combine_chunks(), "totals": pa.array([x.tobytes() for x in per_block], pa.binary()),
        "tokens": pa.array([tokens.tobytes()] + [None] * rest, pa.binary()), "types": pa.array([types.tobytes()] + [None] * rest, pa.binary()), "top": [top] + [None] * rest,
    }, schema=_ANSWER)


@dataclass
class Model:
    alone: np.ndarray  # sorted hashes of the tokens with a class of their own
    alone_class: np.ndarray
    tokens: np.ndarray  # training tokens by class
    types: np.ndarray
    weights: np.ndarray  # ROWS x CLASSES
    frequent: np.ndarray = field(default_factory=lambda: np.zeros(0, U))  # sorted hashes of the words with features of their history
    frequent_class: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    frequent_count: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    pair_weights: np.ndarray = field(default_factory=lambda: np.zeros((WORD_ROWS, 0), np.float32))  # by previous word and frequent word

    @property
    def n_tokens(self) -> int:
        return int(self.tokens.sum())

    @property
    def n_types(self) -> int:
        return int(self.types.sum())

    def classes(self, tokens: Tokens) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.alone, tokens.hashes), len(self.alone) - 1)
        return np.where(self.alone[place] == tokens.hashes, self.alone_class[place], tokens.kind).astype(np.int64)

    def word_log(self, kind: np.ndarray, count: np.ndarray) -> np.ndarray:
        """log10 of P(word | class) without features of the history."""
        whole = self.tokens[kind] + self.types[kind] + 1
        return np.where(kind < ALONE, 0.0, np.log10((count + 1) / whole))

    def frequent_places(self, tokens: Tokens) -> np.ndarray:
        """Place of each token among the frequent words, or -1."""
        if not len(self.frequent):
            return np.full(len(tokens.hashes), -1)
        place = np.minimum(np.searchsorted(self.frequent, tokens.hashes), len(self.frequent) - 1)
        return np.where(self.frequent[place] == tokens.hashes, place, -1)

    def shares(self) -> np.ndarray:
        """P(word | class) of each frequent word without features of the history."""
        return 10 ** self.word_log(self.frequent_class, self.frequent_count)

    def sums(self) -> np.ndarray:
        """Natural logarithm of the sum over each class after each hashed previous word: 1 but for what the frequent words gain or lose."""
        gained = np.zeros((WORD_ROWS, CLASSES))
        np.add.at(gained.T, self.frequent_class, (self.shares() * np.expm1(self.pair_weights.astype(np.float64))).T)
        return np.log1p(gained)

    def history_log(self, kind: np.ndarray, place: np.ndarray, previous: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """log10 of what the history adds to P(word | class); ``previous`` is the row of the word before, ``sums`` that of :meth:`sums`."""
        own = np.zeros(len(kind))
        if len(self.frequent):
            own = np.where(place >= 0, self.pair_weights[previous, place], 0.0)
        return (own - sums[previous, kind]) / np.log(10)

    def fit_pairs(self, pairs: np.ndarray, histories: np.ndarray) -> None:
        """Weights of the features of the history, from the counts of (previous word, word) and (previous word, class)."""
        if not len(self.frequent):
            return
        shares, of = self.shares(), histories[:, self.frequent_class]
        self.pair_weights = np.zeros(pairs.shape, np.float32)
        for _ in range(FITS):
            expected = of * np.exp(self.pair_weights - self.sums()[:, self.frequent_class]) * shares
            self.pair_weights = (self.pair_weights + (pairs - expected) / (np.maximum(pairs, expected) + SMOOTHING)).astype(np.float32)


def _back(values: np.ndarray, place: np.ndarray, k: int, start) -> np.ndarray:
    """The value k tokens before in the same text, or that of the end of text."""
    out = np.empty_like(values)
    out[:k] = start
    out[k:] = values[:-k] if k < len(values) else values[:0]
    out[place < k] = start
    return out


def feature_rows(tokens: Tokens, kind: np.ndarray) -> np.ndarray:
    """Weight row of each of the five features of each token."""
    one, two, three = (_back(kind, tokens.place, k, 0) for k in (1, 2, 3))
    word = lambda k: (mix(_back(tokens.hashes, tokens.place, k, END) + U(k)) % U(WORD_ROWS)).astype(np.int64)
    return np.stack([
        np.zeros(len(kind), np.int64), 1 + word(1), 1 + WORD_ROWS + one * CLASSES + two,
        1 + WORD_ROWS + PAIR_ROWS + word(2), 1 + 2 * WORD_ROWS + PAIR_ROWS + two * CLASSES + three,
    ])


def class_logits(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    out = weights.take(rows[0], axis=0)
    for r in rows[1:]:
        out += weights.take(r, axis=0)
    out -= out.max(axis=1, keepdims=True)
    return out


def _gradient(model: Model):
    """Observed and expected class counts of every feature row, summed over the task's tokens, by range of rows."""

    def run(batches):
        seen, expected = np.zeros((ROWS, CLASSES), np.float32), np.zeros((ROWS, CLASSES), np.float32)
        width = len(model.frequent)
        pairs = np.zeros((WORD_ROWS, width), np.float32)
        for batch in batches:
            for part in steps(batch, "text"):
                tokens = tokenize(part["text"])
                kind = model.classes(tokens)
                rows = feature_rows(tokens, kind)
                for a in range(0, len(kind), CHUNK):
                    own = rows[:, a : a + CHUNK]
                    p = np.exp(class_logits(model.weights, own))
                    p /= p.sum(axis=1, keepdims=True)
                    for r in own:
                        order = np.argsort(r.astype(np.uint16), kind="stable")
                        first = np.flatnonzero(np.concatenate([[True], np.diff(r[order]) != 0]))
                        expected[r[order[first]]] += np.add.reduceat(p[order], first, axis=0)
                cell = (rows * CLASSES + kind).reshape(-1)
                seen += np.bincount(cell, minlength=ROWS * CLASSES).reshape(ROWS, CLASSES).astype(np.float32)
                place = model.frequent_places(tokens)
                found = place >= 0
                if found.any():
                    pair = (rows[1][found] - 1) * width + place[found]
                    pairs += np.bincount(pair, minlength=WORD_ROWS * width).reshape(WORD_ROWS, width).astype(np.float32)
        for k, parts in enumerate(zip(*(np.array_split(x, PARTS) for x in (seen, expected, pairs)))):
            yield _sums_row(k, parts)

    return run


_SUMS = ("seen", "expected", "pairs")


def _sums_row(part: int, sums) -> pa.RecordBatch:
    return pa.record_batch({"part": pa.array([part], pa.int32())} | {c: pa.array([x.tobytes()], pa.binary()) for c, x in zip(_SUMS, sums)})


def _add(batches):
    """Sums of the gradients of each range, in the order they come."""
    total: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for k, *sums in zip(*(batch[c].to_pylist() for c in ("part", *_SUMS))):
            new = [np.frombuffer(x, np.float32).astype(np.float64) for x in sums]
            total[k] = [x + y for x, y in zip(total[k], new)] if k in total else new
    for k, sums in total.items():
        yield _sums_row(k, sums)


def _gradient_of(texts: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    schema = "part int, seen binary, expected binary, pairs binary"
    summed = texts.mapInArrow(_gradient(model), schema).repartition(PARTS, "part").mapInArrow(_add, schema).toArrow()  # of fixed size
    order = np.argsort(summed["part"].to_numpy())
    shapes = ((ROWS, CLASSES), (ROWS, CLASSES), (WORD_ROWS, len(model.frequent)))
    if not len(order):
        return tuple(np.zeros(x) for x in shapes)
    return tuple(np.frombuffer(b"".join(summed[c][int(i)].as_py() for i in order), np.float64).reshape(x) for c, x in zip(_SUMS, shapes))


def train(docs: DataFrame, answers: DataFrame) -> Model:
    """Model of the rows (text, train, step) with train true, given the answers about their words."""
    sums = [np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)]
    # Sums by class, added in Spark: CLASSES numbers reach the driver.
    unpack = answers.where("tokens IS NOT NULL").select("tokens", "types").mapInArrow(_unpack, "kind int, tokens bigint, types bigint")
    for r in unpack.groupBy("kind").agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types")).collect():
        sums[0][r["kind"]], sums[1][r["kind"]] = r["tokens"], r["types"]
    most = answers.select(F.explode("top").alias("w")).select("w.*").where("kind > 0 AND n > 0").orderBy(F.desc("n"), "key").limit(ALONE - 1 + FREQUENT).collect()
    tokens, types = sums
    top, more = most[: ALONE - 1], sorted((r for r in most[ALONE - 1 :] if r["n"] >= CUTOFF), key=lambda r: int(np.int64(r["key"]).astype(U)))
    for k, r in enumerate(top, 1):
        tokens[r["kind"]] -= r["n"]
        types[r["kind"]] -= 1
        tokens[k], types[k] = r["n"], 1
    alone = np.array([END, *(np.int64(r["key"]).astype(U) for r in top)], U)
    order = np.argsort(alone)
    weights = np.zeros((ROWS, CLASSES), np.float32)
    weights[0] = np.log((tokens + 0.5) / (tokens.sum() + 0.5 * CLASSES))
    model = Model(alone[order], np.arange(len(alone))[order], tokens, types, weights)
    model.frequent = np.array([np.int64(r["key"]).astype(U) for r in more], U)
    model.frequent_class, model.frequent_count = (np.array([r[c] for r in more], np.int64) for c in ("kind", "n"))
    model.pair_weights = np.zeros((WORD_ROWS, len(more)), np.float32)
    all_pairs, histories = np.zeros((WORD_ROWS, len(more))), np.zeros((WORD_ROWS, CLASSES))
    for step, rate in enumerate(RATES):
        seen, expected, pairs = _gradient_of(docs.where(F.col("train") & (F.col("step") == step)).select("text"), model)
        model.weights = (model.weights + rate * (seen - expected) / (np.maximum(seen, expected) + SMOOTHING)).astype(np.float32)
        all_pairs += pairs
        histories += seen[1 : 1 + WORD_ROWS]
    model.fit_pairs(all_pairs, histories)
    return model


def _unpack(batches):
    for batch in batches:
        n = batch.num_rows
        both = [np.frombuffer(b"".join(batch[c].to_pylist()), np.int64) for c in ("tokens", "types")]
        yield pa.record_batch({"kind": pa.array(np.tile(np.arange(CLASSES), n), pa.int32()), "tokens": both[0], "types": both[1]})


_SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def _score(model: Model, buckets: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(docs):
            return _SCORES.empty_table()
        key = _block_words(docs)[0]
        by_bucket = answers.sort_by("bucket")  # the order of the keys
        sums = model.sums()
        total = np.frombuffer(b"".join(by_bucket["totals"].to_pylist()), np.int64)
        out = []
        for part in steps(docs, "text"):
            tokens = tokenize(part["text"])
            count = total[np.searchsorted(key, tokens.hashes)]
            kind = model.classes(tokens)
            base = np.log10((count + 1) / (model.n_tokens + model.n_types + 1))
            log = model.word_log(kind, count)
            rows = feature_rows(tokens, kind)
            log += model.history_log(kind, model.frequent_places(tokens), rows[1] - 1, sums)
            for a in range(0, len(kind), CHUNK):
                logits = class_logits(model.weights, rows[:, a : a + CHUNK])
                own = logits[np.arange(len(logits)), kind[a : a + CHUNK]]
                log[a : a + CHUNK] += (own - np.log(np.exp(logits).sum(axis=1))) / np.log(10)
            n = len(tokens.per_text)
            add = lambda x: np.bincount(tokens.text, weights=x, minlength=n)  # noqa: E731, B023
            out.append(pa.table([
                part["doc_id"].combine_chunks(), pa.array(~part["train"].to_numpy()), tokens.per_text.astype(np.int64), add(count > 0).astype(np.int64),
                np.full(n, model.n_tokens), add(base), add(log),
            ], schema=_SCORES))
        return pa.concat_tables(out)

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score (unigrams, add one) and score, the model's
    log10 probability of the text and its end.

    A null or empty text is its end alone. Rows with a null id are learnt from and scored. Repeated rows are learnt
    from and scored each. Other columns are ignored; an empty table gives no rows. A block's texts are held by one task.
    """
    spark = docs.sparkSession
    base, blocks = blocked(docs, id_col, text_col, block_bytes=BLOCK_BYTES)
    base = base.withColumn("train", ~held_out())
    buckets = bucket_count(docs, blocks)
    by_block = base.groupBy("block")
    asked = by_block.applyInArrow(_ask(buckets), "bucket int, block int, keys binary, counts binary, kinds binary")
    answered = asked.groupBy("bucket").applyInArrow(_answer, "bucket int, block int, totals binary, tokens binary, types binary, top array<struct<n: bigint, key: bigint, kind: int>>")
    path = scratch_path(spark, "counts")
    answered.write.option("compression", "zstd").parquet(path)
    answers = spark.read.parquet(path)
    # The scan, not the blocks: training needs no exchange of texts.
    model = train(base.select("text", "train", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(STEPS)).alias("step")), answers)
    totals = answers.select("block", "bucket", "totals").groupBy("block")
    return by_block.cogroup(totals).applyInArrow(
        _score(model, buckets), "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )
