"""Language ID, language model, PII, toxicity and quality rules: exact parts against plain versions, learned ones by held-out rows."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stockcast.llm import class_lm, language, pii, quality, queries, toxicity
from tests.llm import plain
from tests.llm.conftest import as_rows

MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def middle(spark):
    return spark.read.parquet(f"{MIDDLE}/documents.parquet")


# language


def test_language_of_held_out_documents(spark, middle):
    got = language.predict_languages(middle).join(middle.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got["lang"] == got["lang_pred"]).mean() > 0.98 and got["score"].between(0, 1).all()


def test_language_edges(spark, edge, empty):
    got = language.predict_languages(edge).toPandas()
    assert len(got) == edge.count()
    texts = as_rows(edge)
    blank = sum(1 for _, t in texts if not any(c.isalpha() for c in t or ""))
    assert (got["lang_pred"] == "und").sum() == blank and set(got["lang_pred"]) <= {"und", "en", "de"}
    assert language.predict_languages(empty).count() == 0
    unlabelled = edge.withColumn("lang", F.lit(None).cast("string"))
    assert {tuple(r) for r in language.predict_languages(unlabelled).select("lang_pred", "score").collect()} == {("und", 0.0)}


def test_language_inputs_are_text_alone(spark, middle):
    """Held-out languages, sources and other ids of the same fold change no prediction."""
    held = language.fold("doc_id", 3) == 1
    other = middle.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    a, b = (language.predict_languages(x).toPandas().sort_values("doc_id").reset_index(drop=True) for x in (middle, other))
    assert a.equals(b)


def test_every_letter_has_a_vector_of_its_own():
    kinds = language.symbols()
    for first, last in ((0x430, 0x44F), (0x3B1, 0x3C9), (0x621, 0x64A), (0xE0, 0xFF), (0x4E00, 0x4FFF)):
        points = np.unique(kinds[first : last + 1])
        points = points[points > 0]
        vectors = language.letter_vectors(points)
        assert len(np.unique(vectors, axis=0)) == len(points)
        apart = np.abs(vectors @ vectors.T / language.DIMENSIONS - np.eye(len(points)))
        assert apart.max() < 0.25 and set(np.unique(vectors)) == {-1.0, 1.0}


def test_many_letters_give_the_same_codes_and_bounded_slices(monkeypatch):
    """Beyond the size that is numbered anew the codes are sorted; cosines do not hang on the slice."""
    kinds = language.symbols()
    for text in ("the cat", "日本" + "".join(chr(0x4E00 + 7 * k) for k in range(600)), ""):
        _, codes = language.grams([text], kinds)
        seen, place = language.distinct(codes)
        assert (seen[place] == codes).all() and (np.diff(seen) > 0).all()
    texts = ["the cat sat", "".join(chr(0x4E00 + 7 * k) for k in range(600)), None, "Привет мир"]
    model = np.random.default_rng(1).normal(size=(3, 128)).astype(np.float32)
    whole = language.cosines(texts, model, kinds)[0]
    monkeypatch.setattr(language, "SLICE", 5)
    assert np.allclose(whole, language.cosines(texts, model, kinds)[0], atol=1e-5)


def test_predictions_against_plain_bundles(spark, documents):
    """Letter by letter, with dictionaries: the same language and cosine for every document."""
    kinds = language.symbols()
    rows = documents.select("doc_id", "text", "lang", (language.fold("doc_id", 3) == 1).alias("held")).collect()
    cache: dict[str, np.ndarray] = {}

    def bundle(text):
        marks = [0, *(int(kinds[ord(c)]) for c in text or ""), 0]
        out = np.zeros(language.DIMENSIONS)
        for a, b, c in zip(marks, marks[1:], marks[2:], strict=False):
            if b:
                if (a, b, c) not in cache:
                    x, y, z = language.letter_vectors(np.array([a, b, c]))
                    cache[a, b, c] = np.roll(x, 2) * np.roll(y, 1) * z
                out += cache[a, b, c]
        return out

    bundles = {r["doc_id"]: bundle(r["text"]) for r in rows}
    sums: dict[str, np.ndarray] = {}
    for r in rows:
        if not r["held"] and r["lang"] is not None and r["text"] is not None:
            sums[r["lang"]] = sums.get(r["lang"], 0) + bundles[r["doc_id"]]
    unit = lambda v: v / max(np.linalg.norm(v), 1e-12)
    for got in language.predict_languages(documents).collect():
        own = unit(bundles[got["doc_id"]])
        cosine = {k: float(own @ unit(v)) for k, v in sums.items()}
        best = max(sorted(cosine), key=cosine.get)
        if own.any():
            assert got["lang_pred"] == best and got["score"] == pytest.approx(cosine[best], abs=1e-3)
        else:
            assert (got["lang_pred"], got["score"]) == ("und", 0.0)


def test_grams_are_bound_bundles():
    """The product of counts and gram vectors is the bundle made letter by letter."""
    kinds = language.symbols()
    owner, codes = language.grams(["Abc, öd", None, "x"], kinds)
    letters = {int(m): language.letter_vectors(np.array([m]), 64, 1)[0] for m in {0, *kinds[[ord(c) for c in "Abc, öd"]]}}
    bundle = np.zeros(64)
    marks = [0, *kinds[[ord(c) for c in "Abc, öd"]], 0]
    for k in range(1, len(marks) - 1):
        if marks[k]:
            bundle += np.roll(letters[marks[k - 1]], 2) * np.roll(letters[marks[k]], 1) * letters[marks[k + 1]]
    assert np.allclose(language.gram_vectors(codes[owner == 0], 64, 1).sum(axis=0), bundle)
    assert (owner == 2).sum() == 1 and not (owner == 1).any()


# language model


def check_unigrams(df, rows):
    want = plain.unigram_scores(rows)
    for r in df.collect():
        n, known, total, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert abs(r["base_score"] - base) < 1e-6 * max(1, abs(base)) and np.isfinite(r["score"])


def test_base_scores(spark, documents, unique):
    check_unigrams(class_lm.class_scores(documents), as_rows(documents))
    df = spark.createDataFrame(unique, "doc_id long, text string")
    check_unigrams(class_lm.class_scores(df, head=50, classes=4, block_tokens=100), unique)


def test_class_model_beats_unigrams_on_held_out(spark, middle):
    sums = class_lm.class_scores(middle).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert 10 ** (-sums[0] / sums[2]) < 0.8 * 10 ** (-sums[1] / sums[2])


def test_class_model_edges(spark, edge, empty):
    assert class_lm.class_scores(edge).count() == edge.count()
    assert class_lm.class_scores(empty).count() == 0
    held = spark.createDataFrame([(k, "only held out") for k in range(200) if plain.fold(k, 7) == 2], "doc_id long, text string")
    r = class_lm.class_scores(held).first()
    assert r["train_tokens"] == 0 and r["n_known"] == 0 and np.isfinite(r["score"])


def test_exchange_finds_planted_classes(spark):
    """Words of three kinds follow one another in turn."""
    draw = np.random.default_rng(3)
    text = lambda: " ".join(f"{'abc'[k % 3]}{draw.integers(12)}" for k in range(60))
    df = spark.createDataFrame([(k, text()) for k in range(300)], "doc_id long, text string")
    scores = class_lm.class_scores(df, classes=3, mix=0.98).where("held_out").agg(F.sum("score"), F.sum("n_tokens")).first()
    assert 10 ** (-scores[0] / scores[1]) < 15  # 12 words to choose from, 36 without classes


def test_words_outside_the_head_get_classes(spark):
    """As above, but most words of each kind are too rare for the head."""
    draw = np.random.default_rng(4)
    word = lambda kind: f"{kind}{draw.integers(4)}" if draw.random() < 0.5 else f"{kind}x{draw.integers(60)}"
    df = spark.createDataFrame([(k, " ".join(word("abc"[j % 3]) for j in range(60))) for k in range(300)], "doc_id long, text string")
    rows = class_lm.class_scores(df, head=12, classes=3, mix=0.98, block_tokens=500).where("held_out")
    scores = rows.agg(F.sum("score"), F.sum("n_tokens")).first()
    assert 10 ** (-scores[0] / scores[1]) < 40  # 31 from half of 4 and half of 60 words, 93 without classes


def test_transitions_are_distributions():
    table = np.random.default_rng(0).integers(0, 50, (9, 9))
    assert np.allclose(class_lm.transitions(table).sum(axis=1), 1)


# PII

LOOSE = st.text(alphabet="ab.@-+(0123456789 )x%", max_size=120)


@settings(max_examples=400, deadline=None)
@given(LOOSE)
def test_base_spans(text):
    assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(text)] == plain.base_spans(text)


def test_pii_of_documents(spark, middle):
    got = {r["doc_id"]: r for r in pii.find_spans(middle).collect()}
    for doc_id, text in as_rows(middle):
        want = plain.base_spans(text)
        r = got[doc_id]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x[0] == k for x in want) for k in pii.KINDS]
        assert r["base_sha256"] == plain.span_digest(want)
        spans = r["spans"].split(",") if r["spans"] else []
        assert {f"{k}:{a}:{b}" for k, a, b in want} <= set(spans) and len(spans) == len(want) + r["n_added"]


def test_added_card_numbers(spark, middle):
    """Two card numbers that stand together are no base match; the trees find both."""
    card = "4111 1111 1111 1111"
    odd = spark.createDataFrame([(10**6, f"pay with {card} 5500 0000 0000 0004 now"), (10**6 + 1, "no data 12 here")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.find_spans(middle.select("doc_id", "text").unionByName(odd)).collect()}
    assert got[10**6]["n_card"] == 0 and "card:9:28" in got[10**6]["spans"]
    assert got[10**6 + 1]["spans"] == ""


@pytest.mark.parametrize("text", ["name [ at ] host [ dot ] org", "name (At) host.org", "name[aT ]host(DOT)org", "name (at) host.org"])
def test_spelled_addresses_are_proposed(text):
    assert (0, 0, len(text)) in pii.candidates(text)


def test_redaction_keeps_rows_and_clean_texts(spark, middle, edge, empty):
    before, after = dict(as_rows(middle)), dict(as_rows(pii.redact(middle)))
    assert before.keys() == after.keys()
    for k, text in before.items():
        found = plain.base_spans(text)
        assert not plain.base_spans(after[k])
        if not found and not any(c.isdigit() or c == "@" for c in text):
            assert after[k] == text
    assert pii.redact(edge).columns == edge.columns and pii.redact(edge).count() == edge.count()
    assert pii.redact(empty).count() == pii.find_spans(empty).count() == 0
    assert pii.find_spans(edge).count() == edge.count()


def test_trees_learn_a_rule():
    x = np.random.default_rng(1).random((2000, 4))
    y = ((x[:, 1] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    model = pii.boost(x[:1000], y[:1000])
    assert ((pii.margin(model, x[1000:]) > 0) == y[1000:]).mean() > 0.95


def _candidates(spark, n, odd):
    """`n` easy candidates, and `odd` that break a rule, as one scanned row of each text."""
    rows, draw = [], np.random.default_rng(3)
    for k in range(n + odd):
        x = np.zeros((1, len(pii.NAMES)), np.float32)
        x[0, 0], x[0, 1], x[0, 2] = k % 4, draw.integers(5, 30), (k >= n) * 9 + draw.integers(0, 5)
        rows.append((k, bytearray(x.tobytes()), bytearray(np.array([k < n], np.int8).tobytes())))
    return spark.createDataFrame(rows, "doc_id long, features binary, labels binary").repartition(5)


def _same(a, b):
    plain = lambda m: [m["start"], *map(list, m["edges"]), *[list(v) for t in m["trees"] for v in t], list(m["curve"]), m["limits"]]
    return plain(a) == plain(b)


def test_every_labelled_candidate_counts(spark):
    n, odd = 24_000, 6_000
    model = pii.learn(_candidates(spark, n, odd))
    order = spark.range(n + odd).select((F.col("id") < n).alias("y")).orderBy(F.xxhash64("id", F.lit(0))).collect()
    positive = sum(r["y"] for r in order[::2])
    assert model["start"] == pytest.approx(np.log((positive + 1) / (len(order) / 2 - positive + 1)), abs=1e-12)


def test_passes_of_tasks_give_the_same_model(spark):
    rows = _candidates(spark, 600, 200)
    one, many = pii.learn(rows), pii.learn(rows.repartition(3), one_task=150)
    assert one["trees"] and _same(one, many)


# toxicity


def plain_segments(scores):
    """All maximal segments by their definition: the best one, then the same left and right of it."""
    best = None
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            total = sum(scores[a:b])
            if total > 0 and (best is None or total > best[0] or total == best[0] and b - a < best[2] - best[1]):
                best = (total, a, b)
    if best is None:
        return []
    total, a, b = best
    return [*plain_segments(scores[:a]), (a, b, total), *[(x + b, y + b, s) for x, y, s in plain_segments(scores[b:])]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-64, 64).map(lambda x: (2 * x + 1) / 8 + x * x / 4096), max_size=14))
def test_segments(scores):
    got = [(a, b, round(s, 6)) for a, b, s in toxicity.segments(np.array(scores, float))]
    want = [(a, b, round(s, 6)) for a, b, s in plain_segments(scores)]
    assert sum(s for *_, s in got) == pytest.approx(sum(s for *_, s in want)) and len(got) == len(want)


def test_toxicity_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    toxic, clean = got[got["toxic"] == 1], got[got["toxic"] == 0]
    assert toxic["predicted"].mean() > 0.85 and clean["predicted"].mean() < 0.05


def test_toxicity_edges(spark, edge, empty, documents, labels):
    got = toxicity.toxicity(edge.unionByName(documents, allowMissingColumns=True), labels).toPandas()
    assert got["score"].between(0, 1).all() and len(got) == edge.count() + documents.count()
    assert toxicity.toxicity(empty, labels).count() == 0
    none = labels.where("false")
    assert toxicity.toxicity(edge, none).where("predicted = 1").count() == 0
    assert toxicity.drop_toxic(edge, none).count() == edge.count()
    odd = labels.withColumn("toxic", F.lit(None).cast("int")).unionByName(labels)
    assert toxicity.drop_toxic(documents, odd).columns == documents.columns


# quality


def test_quality_base(spark, documents, unique):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    for rows in (as_rows(documents), unique):
        df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en"))
        got = {r["doc_id"]: r for r in quality.verdicts(df, labels).collect()}
        for doc_id, text in rows:
            r = got[doc_id]
            assert tuple(r[c] for c in [*quality.MEASURES, "base_failed"]) == plain.quality_base(text)
            assert not (r["base_failed"] and r["kept"])


def test_upper_bound_is_exact():
    """The bound is where the binomial tail equals the miss probability."""
    from math import comb

    for bad, n in ((0, 50), (3, 80), (10, 40), (0, 1), (1, 2), (120, 130), (90, 900)):
        p = quality.upper_bound(bad, n, 0.01)
        assert sum(comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(bad + 1)) == pytest.approx(0.01, rel=1e-6)
    assert quality.upper_bound(5, 5, 0.1) == 1.0


def test_binomial_tail_against_sums():
    from math import comb

    for n in (1, 2, 5, 50, 200, 900):
        for bad in sorted({0, min(1, n - 1), n // 7, n // 2, n - 1}):
            for rate in (1e-6, 0.001, 0.01, 0.1, 0.3, 0.5, 0.7, 0.9, 0.999):
                want = sum(comb(n, k) * rate**k * (1 - rate) ** (n - k) for k in range(bad + 1))
                assert quality.binomial_tail(bad, n, rate) == pytest.approx(want, rel=1e-9, abs=1e-12)


def test_bound_of_many_labels_is_quick_and_closes_in():
    """Bounds shrink to the rate with the labels; a sum over every rejected document would take hours here."""
    found = [quality.upper_bound(n // 100, n, 1e-5) for n in (10**3, 10**5, 10**7, 10**9)]
    assert found == sorted(found, reverse=True) and 0.01 < found[-1] < 0.0101


def test_cutoffs_of_many_strata_are_chosen_apart(spark):
    """One stratum at a time gives what all together give, with the tests of all counted."""
    steps = len(quality.GRID)
    counts = [(s, 1, r, steps, 6000) for s in ("a", "b") for r in quality.RULES] + [
        (s, 0, r, k, 100) for s, k in (("a", 3), ("b", 9)) for r in quality.RULES]
    apart = [x for s in ("a", "b") for x in quality.choose([c for c in counts if c[0] == s], 2)]
    assert apart == quality.choose(counts) and len(apart) == 2 * len(quality.RULES)
    # few labels a stratum suffice for none
    many = [(f"s{k}", *c[1:]) for k in range(40) for c in [("", 1, r, steps, 90) for r in quality.RULES]]
    assert quality.choose(many + [("s1", 0, "digit_share", 2, 30)]) == []


def test_cutoffs_keep_their_promise():
    """A rule that separates is used where labels suffice, and not where they are few."""
    step = len(quality.GRID) // 2
    many = [("en", 1, r, len(quality.GRID), 5000) for r in quality.RULES] + [("en", 0, r, step, 300) for r in quality.RULES]
    few = [("fr", 1, r, len(quality.GRID), 60) for r in quality.RULES] + [("fr", 0, r, step, 30) for r in quality.RULES]
    chosen = quality.choose(many + few)
    assert {s for s, _, _ in chosen} == {"en"} and {c for _, _, c in chosen} == {quality.GRID[step]}


def test_quality_keeps_good_documents(spark):
    got = queries.op9_quality_rules(spark, "/root/testdata/sf0.1").join(
        spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("not base_failed").toPandas()
    good, bad = got[got["quality"] == 1], got[got["quality"] == 0]
    assert (~good["kept"]).mean() < quality.ALPHA and (~bad["kept"]).mean() > 0.3


def test_quality_edges(spark, edge, empty, labels):
    assert quality.verdicts(edge, labels).count() == edge.count()
    assert quality.verdicts(empty, labels).count() == 0
    assert quality.verdicts(edge, labels.where("false")).where("not base_failed and not kept").count() == 0
