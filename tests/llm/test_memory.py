"""What a task holds and hands over at once."""

import pyarrow as pa

from stockcast.llm import pii, shingle_join, text, toxicity


def taken(monkeypatch, module, make) -> list:
    """What the function that `make` hands to on_batches yields, as lists by call; it runs here."""
    kept = []

    def fake(frame, work, schema, rows=text.BATCH_ROWS):
        kept.append(work)
        return text.on_batches(frame, work, schema, rows)

    monkeypatch.setattr(module, "on_batches", fake)
    make()
    return kept


def test_candidates_of_a_batch_leave_it_together(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"call +1 (017) 555-{k:04d} or 1.2.3.{k} or 1.2.3.400") for k in range(200)] + [(None, None)], "doc_id long, text string")
    scanned = pii.scan(docs)
    work = taken(monkeypatch, pii, lambda: pii.labelled(scanned))[0]
    (batch,) = scanned.where("length(labels) > 0").select("doc_id", "features", "labels").toArrow().combine_chunks().to_batches()
    (made,) = work(iter([batch]))
    assert len(made["doc_id"]) == len(made["at"]) == len(made["y"]) == len(made["x0"]) >= 600
    one_by_one = [row for k in range(batch.num_rows) for part in work(iter([batch.slice(k, 1)])) for row in zip(*(list(c) for c in part.values()), strict=True)]
    assert list(zip(*(list(c) for c in made.values()), strict=True)) == one_by_one


def test_prefixes_of_a_batch_leave_it_together(spark, monkeypatch):
    docs = spark.createDataFrame([(k, " ".join(f"w{k * n % 97}" for n in range(60))) for k in range(100)], "doc_id long, text string")
    counts = shingle_join.bucket_counts(docs)
    work = taken(monkeypatch, shingle_join, lambda: shingle_join._entries(docs, counts, 16, 75, 100))[0]
    (batch,) = shingle_join._with_text(docs).toArrow().combine_chunks().to_batches()
    rows, prefixes = work(iter([batch]))
    assert rows["kind"] == [0] * 100 and prefixes["kind"] == [1] * 16 and prefixes["owner"] == list(range(16))
    assert all(len(column) == 16 for column in prefixes.values())


def test_word_tables_stay_small(monkeypatch):
    for table in (text.Interned(), toxicity.TokenScores({})):
        words = [b"%d" % k for k in range(300_000)]
        first = [table[w] for w in words[:1000]]
        for word in words:
            table[word]
        assert len(table) <= 1 << 17 and [table[w] for w in words[:1000]] == first


def test_a_task_counts_in_parts_that_add_up(spark, monkeypatch):
    rows = spark.createDataFrame([(f"word{k} other{k % 7} some", k % 2) for k in range(300)], "text string, toxic int")
    work = taken(monkeypatch, toxicity, lambda: toxicity.key_counts(rows))[0]
    batches = rows.toArrow().combine_chunks().to_batches(max_chunksize=30)

    def added(parts) -> dict:
        total: dict = {}
        for part in parts:
            for key, clean, toxic in zip(part["key"], part["clean"], part["toxic"], strict=True):
                at = total.setdefault(key, [0, 0])
                at[0], at[1] = at[0] + clean, at[1] + toxic
        return total

    whole = list(work(iter(batches)))
    monkeypatch.setattr(toxicity, "REMEMBERED_WORDS", 50)
    parts = list(work(iter(batches)))
    assert len(whole) == 1 and len(parts) > 3 and max(len(p["key"]) for p in parts) < 300
    assert added(parts) == added(whole)


def test_tasks_give_arrow_memory_back(monkeypatch):
    given = []

    class Pool:
        def release_unused(self):
            given.append(True)

    monkeypatch.setattr(text.pa, "default_memory_pool", Pool)
    batch = pa.RecordBatch.from_pydict({"a": [1]})
    assert list(text._giving_back(lambda parts: parts)(iter([batch, batch]))) == [batch, batch] and given == [True]
