import corpus_pipeline
import pyarrow as pa
import public_tokenizers
import pytest
from helpers import prose, roots, shingle_set
from test_near_and_lines import expected_lines
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm import decontamination, tables
from riskloom.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with insults, repeated lines, near copies and benchmark passages, among clean ones."""
    where = str(tmp_path_factory.mktemp("corpus"))
    insults = ["blockhead", "nincompoop", "dunderhead"]
    item = prose(900, 30)
    rows, labels = [], []
    for i in range(160):
        text = prose(i, 50) + "\n" + prose(4000 + i, 20)
        bad = i % 4 == 0
        if bad:
            words = text.split(" ")
            words[10:10] = [insults[i // 4 % 3], "and", insults[(i // 4 + 1) % 3]]
            text = " ".join(words)
        if i % 10 == 3:
            text += "\n" + prose(777, 12)
        if i % 40 == 5:
            text = prose(i, 50) + " " + item + " " + prose(2000 + i, 40)
        rows.append((i, text, "en", "s", len(text)))
        labels.append((i, 0, int(bad)))
    base = prose(5000, 90).split()
    for k in range(4):
        copy = base.copy()
        copy[20 * k] = "other"
        width = (7, 11, 16, 23)[k]  # broken into other lines, so that no line is like one of another copy
        rows.append((200 + k, "\n".join(" ".join(copy[i : i + width]) for i in range(0, 90, width)), "en", "s", 1))
    rows += [(300, None, None, None, None), (301, "", "en", "s", 0), (None, prose(6000, 30), "en", "s", 5)]
    rows += [(None, " ".join(base), "en", "s", 5), (None, prose(6001, 30) + " " + item, "en", "s", 5), (None, prose(6002, 40) + "\n" + prose(777, 12), "en", "s", 5)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame([(1, item), (2, prose(901, 25))], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return where


def keyed(rows):
    """Rows without an id come after all others."""
    return [(10_000 + i if d is None else d, t) for i, (d, t) in enumerate(rows)]


def as_found(rows):
    return sorted((-1 if d is None or d >= 10_000 else d, t is None, t or "") for d, t in rows)


def test_every_stage_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "decontamination", "bpe_encoding"]
    texts, columns = [(r.doc_id, r.text) for r in docs.collect()], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "bpe_encoding":
            assert out.columns == columns and out.dtypes == docs.dtypes
        path = f"{folder}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        after = docs.collect()
        if name == "toxicity":
            assert {r.doc_id for r in after} == {d for d, _ in texts if d is None or d % 4 or d >= 200 or d % 40 == 5} | {200, 300}
        elif name == "line_dedup":
            gone = expected_lines(keyed(texts), min_words=1)
            left = [(d, t and "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone.get(d, []))) for d, t in keyed(texts)]
            assert gone and as_found((r.doc_id, r.text) for r in after) == as_found(left)
            assert all(r.n_chars == len(r.text) for r in after if r.text is not None)
        elif name == "near_dedup":
            sets = {d: shingle_set(t, 5) for d, t in keyed(texts)}
            links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
            kept = {d for d, r in roots(sets, links).items() if d == r}
            assert links and any(d >= 10_000 and d not in kept for d in sets)
            assert as_found((r.doc_id, r.text) for r in after) == as_found((d, t) for d, t in keyed(texts) if d in kept)
        elif name == "decontamination":
            items = [decontamination.shingle_words(r.text.encode(), 5) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            hit = {d for d, t in keyed(texts) for i in items if len(i & decontamination.shingle_words((t or "").encode(), 5)) >= 0.8 * len(i)}
            assert any(d >= 10_000 for d in hit) and any(d < 10_000 for d in hit)
            assert as_found((r.doc_id, r.text) for r in after) == as_found((d, t) for d, t in keyed(texts) if d not in hit)
        else:
            library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            wanted = [(-1 if d is None else d, library.encode(t or "", add_special_tokens=False).ids) for d, t in texts]
            assert sorted((-1 if r.doc_id is None else r.doc_id, r.ids) for r in after) == sorted(wanted)
        if name != "bpe_encoding":
            texts = [(r.doc_id, r.text) for r in after]
    counts = lambda df: sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens) for r in df.collect())
    assert counts(corpus_pipeline.run(spark, folder)) == counts(docs)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, small, name):
    from check_oracle import compare, connect

    assert compare(connect(small), QUERIES[name](spark, small), ORACLES[name]) is None


def test_queries_are_registered():
    import __spark_entry__

    known = __spark_entry__.queries()
    assert known["pipeline"] is corpus_pipeline.run and set(QUERIES) <= set(known)
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


def test_texts_come_in_small_batches(spark, monkeypatch):
    def sizes(docs, path):
        return docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"doc_id": [0], "n_tokens": [b.num_rows], "ids": ["0"]}) for b in batches), "doc_id long, n_tokens long, ids string")

    monkeypatch.setattr(corpus_pipeline, "encoded", sizes)
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("a text").alias("text")).coalesce(1)
    before = spark.conf.get(tables.BATCH)
    try:
        spark.conf.unset(tables.BATCH)
        found = [r.n_tokens for r in corpus_pipeline.encoding_stage(spark, docs, "").collect()]
        assert sum(found) == 2000 and max(found) <= 500
        with tables.narrow_batches(spark):
            assert spark.conf.get(tables.BATCH) == tables.SPARK_BATCH_ROWS
        assert spark.conf.get(tables.BATCH) == tables.TEXT_BATCH_ROWS
        spark.conf.set(tables.BATCH, "77")
        tables.text_batches(spark)
        with tables.narrow_batches(spark):
            assert spark.conf.get(tables.BATCH) == "77"
    finally:
        spark.conf.set(tables.BATCH, before)
