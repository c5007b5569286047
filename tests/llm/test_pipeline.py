import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P
from tests.llm.test_near_dedup import brute
from tributary.llm import quality_classifier

FOLDER = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    """Each stage against a brute-force version of its decision, on what the one before kept."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    items = [" ".join(r.text.split()) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    before = {r.doc_id: r.text for r in docs.collect()}
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, FOLDER)
        if k < 4:
            assert out.columns == P.COLUMNS
        out.write.parquet(path := str(tmp_path / str(k)))
        docs = spark.read.parquet(path)
        if k == 4:
            break
        after = {r.doc_id: r.text for r in docs.collect()}
        if name == "quality classifier":
            good = [i for i in before if labels.get(i) == 1]
            assert len([i for i in good if i in after]) >= 0.99 * len(good)
            bad = [i for i in before if labels.get(i) == 0]
            assert len([i for i in bad if i in after]) <= 0.1 * len(bad)
            model = quality_classifier.fit_on_labels(spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet"))
            scores = quality_classifier.score(spark.read.parquet(f"{FOLDER}/documents.parquet"), model)
            assert after.keys() == {r.doc_id for r in scores.where("score >= 0.3").collect()}
        elif name == "near-dedup":
            assert after.keys() == {c for _, c in brute(sorted(before.items()))}
        elif name == "decontamination":
            assert after.keys() == {i for i, t in before.items() if not any(x in " ".join(t.split()) for x in items)}
        else:
            assert after.keys() == before.keys() and any(after[i] != before[i] for i in after)
            assert {i: len(t) for i, t in after.items()} == {r.doc_id: r.n_chars for r in docs.collect()}
        if name != "pii":
            assert all(after[i] == before[i] for i in after)
        before = after
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    total = {}
    for r in docs.collect():
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == {i: len(plain.encode(t, add_special_tokens=False).ids) + 1 for i, t in before.items()}
    assert len({(r.sequence_id, r.offset) for r in docs.collect()}) == docs.count()


def test_run_registers(spark):
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is P.run and "pipeline" not in __spark_entry__.oracle_sql()
    assert P.run(spark, "/root/testdata/sf0.001").count() > 0


def edge_rows(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns named like those of the operators."""
    plain = "a quiet report about the harbour and the weather of the coming week in the north"
    rows = [(1, plain), (1, plain), (2, plain), (3, None), (4, ""), (5, "  \n"), (None, plain), (6, "call 438-555-7372 or mail a.b@c.org about the report of the week"), (7, "word " * 30_000), (8, "word " * 30_000)]
    more = "lang string, source string, n_chars bigint, score double, predicted string, class_id bigint, rank int, block int, label int"
    return spark.createDataFrame([(i, t, None, None, None, 0.5, "x", 9, 1, 2, 0) for i, t in rows], f"doc_id bigint, text string, {more}").repartition(3)


def test_edges_of_every_stage(spark):
    docs, stages = edge_rows(spark), dict(P.STAGES)
    texts = sorted([(r.doc_id, r.text) for r in docs.collect()], key=str)
    rows = lambda df: sorted([(r.doc_id, r.text) for r in df.collect()], key=str)
    judged = rows(stages["quality classifier"](spark, docs, FOLDER))
    assert set(judged) <= set(texts) and judged.count(texts[0]) in (0, texts.count(texts[0]))
    kept = rows(stages["near-dedup"](spark, docs, FOLDER))
    assert kept == [(i, t) for i, t in texts if i not in (2, 8)]
    assert rows(stages["decontamination"](spark, docs, FOLDER)) == texts
    private = stages["pii"](spark, docs, FOLDER)
    assert all(new == old for (_, new), (i, old) in zip(rows(private), texts) if i != 6)
    (six,) = [r for r in private.collect() if r.doc_id == 6]
    assert "438-555-7372" not in six.text and "a.b@c.org" not in six.text and six.n_chars == len(six.text)
    pieces = stages["packing"](spark, docs, FOLDER).collect()
    assert sum(r.length for r in pieces if r.doc_id in (3, 4)) == 2 and sum(r.length for r in pieces if r.doc_id == 7) > 30_000
    for name, stage in P.STAGES:
        assert stage(spark, docs.where("false"), FOLDER).count() == 0, name
