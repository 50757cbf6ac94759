"""Quality rules, toxicity, mixing and the pipeline."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tripwright.llm import mixing, quality, queries, toxicity

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def base_counts(text):
    w = WORD.findall(text or "")
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    many, covered, seen, again = Counter(grams), set(), set(), 0
    for i, g in enumerate(grams):
        if many[g] > 1:
            covered |= {i, i + 1, i + 2}
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(covered)


def test_counts_against_plain_python(spark, small, odd):
    docs = queries.table(spark, small, "documents").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = Counter((r.doc_id, *(r[n] for n in names)) for r in quality.document_counts(docs).collect())
    assert got == Counter((r.doc_id, *base_counts(r.text)) for r in docs.collect())


def test_query_of_quality_rules(spark, small):
    rows = queries.QUERIES["op8_quality_rules"](spark, small).collect()
    labels = {r.doc_id: r.quality for r in queries.table(spark, small, "labels").collect()}
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    clean = [r for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed]
    assert sum(r.kept for r in clean) >= 0.98 * len(clean)


def test_em_finds_accuracies():
    rng = np.random.default_rng(0)
    good = rng.random(40_000) < 0.85
    votes = np.zeros((len(good), 5), dtype=np.int64)
    for j, (hit, false) in enumerate(((0.5, 0.01), (0.4, 0.02), (0.6, 0.01), (0.3, 0.005), (0.5, 0.02))):
        votes[:, j] = np.where(rng.random(len(good)) < np.where(good, false, hit), -1, 0)
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    fitted = quality.fit(patterns, n.astype(float))
    assert abs(fitted.good - 0.85) < 0.03
    assert np.abs(fitted.table[:, 0, 0] - [0.5, 0.4, 0.6, 0.3, 0.5]).max() < 0.08
    assert (fitted.accuracy() > 0.5).all()
    assert ((fitted.log_odds(votes) > 0) == good).mean() > 0.95
    assert quality.fit(np.zeros((0, 3), int), np.zeros(0)).good == quality.START_GOOD


def test_quality_of_odd_rows(spark, odd, none):
    rows = quality.judge(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r.posterior <= 1 for r in rows)
    assert all(r.n_words == 0 for r in rows if not (r.n_letters or r.n_words))
    assert quality.judge(none).count() == 0


def texts_with(words, n, seed):
    rng = np.random.default_rng(seed)
    common = [f"{a}{b}{c}" for a in ("the", "an", "ti", "re") for b in ("on", "er", "ha") for c in ("nd", "ou", "st", "ing")]
    out = []
    for _ in range(n):
        w = list(rng.choice(common, rng.integers(20, 400)))
        for word in words and rng.choice(words, 4):
            w[rng.integers(0, len(w))] = word
        out.append(" ".join(w))
    return out


def test_toxicity_held_out_and_misspelt():
    bad = ["idiot", "stupid", "worthless", "pathetic"]
    text = pa.array(texts_with(bad, 300, 1) + texts_with([], 300, 2))
    order = np.random.default_rng(3).permutation(600)
    toxic = np.repeat([1, 0], 300)
    model = toxicity.train(text.take(pa.array(order)), toxic[order])
    assert (model.scores(pa.array(texts_with(bad, 100, 4))) >= 0.5).mean() > 0.95
    assert (model.scores(pa.array(texts_with([], 100, 5))) >= 0.5).mean() < 0.05
    # Words never seen share n-grams with known ones.
    misspelt = pa.array(texts_with(["idiott", "stupiid", "worthlesss", "patheticc"], 100, 6))
    assert (model.scores(misspelt) >= 0.5).mean() > 0.8
    long = " ".join(texts_with([], 200, 7)) + " idiot " + " ".join(texts_with([], 5, 8))
    assert model.scores(pa.array([long]))[0] >= 0.5
    back = toxicity.Model.from_bytes(model.to_bytes())
    assert (back.scores(text) == model.scores(text)).all()


def test_toxicity_query(spark, small):
    rows = queries.QUERIES["op9_toxicity"](spark, small).collect()
    assert len(rows) == queries.table(spark, small, "documents").count()
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_a_long_text_does_not_end_the_training_set(spark):
    bad = texts_with(["idiot", "stupid"], 100, 1)
    rows = [(0, "word " * 5000, 0)] + [(k + 1, t, k % 2) for k, t in enumerate(x for pair in zip(texts_with([], 100, 2), bad) for x in pair)]
    sample = spark.createDataFrame(rows, "key long, text string, toxic int")
    total = sum(len(WORD.findall(t)) for _, t, _ in rows[1:])
    model = toxicity.fit(sample, max_words=total + 4000)
    found = model.scores(pa.array(bad)) >= 0.5
    assert found.mean() > 0.95 and (model.scores(pa.array(texts_with([], 100, 3))) >= 0.5).mean() < 0.05
    words, toxic = np.array([10, 900, 10, 10, 900]), np.array([0, 0, 1, 0, 1])
    assert toxicity._fitting(words, toxic, 100).tolist() == [True, False, True, True, False]
    assert toxicity._fitting(words, toxic, 5000).all() and toxicity._fitting(words, toxic, 10).sum() == 2


@pytest.mark.parametrize("given", [[], [(1, 1), (3, None), (None, 0)], [(5, 0), (6, 0), (6, 1), (8, 1), (7, 0)]])
def test_toxicity_of_odd_rows(spark, odd, none, given):
    labels = spark.createDataFrame(given, "doc_id long, toxic int")
    docs = odd.drop("score")
    model = toxicity.fit(toxicity.labelled(docs, labels))
    scored = toxicity.score(docs, model)
    assert scored.columns == [*docs.columns, "score"] and scored.where("score between 0 and 1").count() == docs.count()
    assert toxicity.score(none, model).count() == 0


def mixed(spark, small, **options):
    docs = queries.table(spark, small, "documents")
    return docs, mixing.mix(docs, queries.language_labels(docs, queries.table(spark, small, "labels")), **options)


def test_rates_meet_targets(spark, small):
    docs, m = mixed(spark, small, targets={"en": 0.25, "de": 0.25, "fr": 0.25, "es": 0.25})
    rows = m.rows.collect()
    p, n, rate = np.array([r.p for r in rows]), np.array([r.n_tokens for r in rows]), np.array([r.rate for r in rows])
    assert (rate >= 0).all() and np.allclose(p.sum(1), 1)
    met = (p * (n * rate)[:, None]).sum(0)
    assert np.allclose(met, list(m.goals.values()), rtol=1e-4) and np.allclose(met, n.sum() / 4, rtol=1e-4)
    assert {r.doc_id: r.n_tokens for r in rows} == {r.doc_id: len(re.findall(r"[^\x20\x09-\x0d]+", r.text)) for r in docs.collect()}
    assert all(abs(r.copies - r.rate) < 1 for r in rows)
    languages = {r.doc_id: r.lang for r in docs.collect()}
    domains = list(m.goals)
    right = np.mean([domains[int(np.argmax(r.p))] == languages[r.doc_id] for r in rows if r.n_tokens >= 20])
    assert right > 0.9
    assert mixing.repeat(docs, m).count() == sum(r.copies for r in rows)


def test_rates_against_dense_projected_gradient(spark, small):
    """One domain is to vanish, so rates are cut at 0."""
    _, m = mixed(spark, small, targets={"de": 0.5, "fr": 0.5})
    rows = m.rows.collect()
    p, n = np.array([r.p for r in rows]), np.array([r.n_tokens for r in rows], float)
    goals = np.array(list(m.goals.values()))
    metric = np.linalg.pinv((p * n[:, None]).T @ p)
    rate = np.ones(len(rows))
    for _ in range(m.rounds):
        rate = np.where(n > 0, np.maximum(0, rate - p @ (metric @ ((p * (n * rate)[:, None]).sum(0) - goals))), 1)
    assert np.allclose(rate, [r.rate for r in rows], atol=1e-6)
    before = np.linalg.norm((p * n[:, None]).sum(0) - goals)
    assert np.linalg.norm((p * (n * rate)[:, None]).sum(0) - goals) < 0.05 * before


def test_growing_loses_no_document(spark, small):
    docs, m = mixed(spark, small, grow=True)
    assert m.rows.where("copies < 1 or rate < 1").count() == 0
    again = mixing.repeat(docs, m)
    assert again.columns == docs.columns and again.select("doc_id").distinct().count() == docs.count()


def test_mixing_of_odd_rows(spark, odd, none):
    labels = odd.select("doc_id", F.col("lang").alias("domain"))
    m = mixing.mix(odd, labels, grow=True)
    assert m.rows.count() == odd.count()
    assert m.rows.where("n_tokens = 0 and rate <> 1").count() == 0
    assert mixing.repeat(odd, m).columns == odd.columns
    assert mixing.mix(none, labels).rows.count() == 0
    unlabelled = mixing.mix(odd, labels.limit(0))
    assert unlabelled.goals == {} and {r.copies for r in unlabelled.rows.collect()} == {1}


def test_tokens_of_sources_meet_their_weights(spark, small):
    """Texts do not tell their source: what the documents name counts."""
    source = {r.doc_id: r.source for r in queries.table(spark, small, "documents").collect()}
    before, after = Counter(), Counter()
    for r in queries.QUERIES["op4_mixing"](spark, small).collect():
        before[source[r.doc_id]] += r.n_tokens
        after[source[r.doc_id]] += r.n_tokens * r.rate
    assert len(before) > 10
    scale = sum(before.values()) / sum(x**0.7 for x in before.values())
    assert all(np.isclose(after[s], scale * before[s] ** 0.7, rtol=1e-4) for s in before)


def test_rows_without_a_source_are_classified(spark):
    rows = [(i, "some words of one" if i % 3 else "other text of two", None if i % 10 == 0 else "one" if i % 3 else "two") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    m = mixing.mix(docs, queries.source_labels(docs), given="source")
    got = {r.doc_id: r.p for r in m.rows.collect()}
    assert len(got) == 60 and list(m.goals) == ["one", "two"]
    assert all((got[i][0] > 0.5) == (i % 3 > 0) and (got[i][0] in (0, 1)) == (i % 10 > 0) for i in got)


def test_no_domain_is_dropped(spark):
    rows = [(i, f"w{i % 65} w{i % 65} common", f"d{i % 65}") for i in range(130)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, domain string")
    with pytest.raises(ValueError, match="64 domains"):
        mixing.mix(docs, docs.select("doc_id", "domain"))
    with pytest.raises(ValueError, match="unknown"):
        mixing.mix(docs, docs.where("domain < 'd2'").select("doc_id", "domain"), targets={"d1": 0.5, "unknown": 0.5})


def test_rare_domains_are_sampled(spark):
    rows = [(i, "rare words here" if i % 500 == 0 else "many other words", "rare" if i % 500 == 0 else "common") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, domain string")
    model = mixing.train(docs, docs.select("doc_id", "domain"), sample=40)
    weights = {r.word: r.weights for r in model.words.collect()}
    assert model.domains == ("common", "rare") and weights["rare"][1] - weights["rare"][0] > 1
    p = mixing.posteriors(docs, model)
    assert p.where("p[1] > 0.5").count() == 8


def test_every_row_is_classified_and_both_kinds_of_goals_are_met(spark, small):
    docs = {r.doc_id: r for r in queries.table(spark, small, "documents").collect()}
    rows = queries.QUERIES["op4_mixing"](spark, small).collect()
    m = queries.mixture_of(queries.table(spark, small, "documents"), queries.table(spark, small, "labels"))
    domains = list(m.goals)
    p, n, rate = np.array([r.posterior for r in rows]), np.array([r.n_tokens for r in rows]), np.array([r.rate for r in rows])
    assert len(rows) == len(docs) and np.allclose(p.sum(1), 1)
    assert ((p > 0) & (p < 1)).any(1).sum() > len(rows) / 2
    found = [domains[k].split("/")[0] for k in p.argmax(1)]
    assert np.mean([x == docs[r.doc_id].lang for x, r in zip(found, rows)]) > 0.9
    weights = queries.quality_targets(dict(zip(domains, (p * n[:, None]).sum(0))))
    goals = np.array([weights[d] for d in domains]) / sum(weights.values()) * n.sum()
    assert np.allclose((p * (n * rate)[:, None]).sum(0), goals, rtol=1e-4) and m.missed < 1e-6
    # Texts of one source differ in their rates: the classifier counts.
    assert max(np.ptp([x for r, x in zip(rows, rate) if docs[r.doc_id].source == s]) for s in {d.source for d in docs.values()}) > 0.1


def test_groups_beside_domains_against_dense_projected_gradient(spark):
    """More groups than there may be domains, one row without, and a domain that nearly vanishes, so rates are cut."""
    rows = [(i, f"{('red', 'blue', 'grey')[i * i % 3 if i < 300 else 2]} text " * (1 + i % 7), None if i == 5 else f"g{i % 70}") for i in range(420)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part string")
    labels = docs.where("doc_id % 2 = 0").select("doc_id", F.expr("split(text, ' ')[0]").alias("domain"))
    m = mixing.mix(docs, labels, {"red": 0.02, "blue": 0.28, "grey": 0.7}, groups="part")
    got = m.rows.collect()
    p, n, rate = np.array([r.p for r in got]), np.array([r.n_tokens for r in got], float), np.array([r.rate for r in got])
    names = sorted({r.group for r in got if r.group})
    one_hot = np.array([[r.group == g for g in names] for r in got], float)
    assert len(names) == 70 and (rate >= 0).all() and len(got) == 420
    a = np.hstack([p, one_hot])
    weigh = (one_hot * n[:, None]).sum(0) ** mixing.TEMPERATURE
    of_groups = weigh / weigh.sum() * (one_hot * n[:, None]).sum()
    goals = np.concatenate([list(m.goals.values()), of_groups])
    gram, dense = (a * n[:, None]).T @ a, np.ones(len(got))
    for _ in range(m.rounds):
        dense = np.maximum(0, dense - a @ np.linalg.lstsq(gram, (a * (n * dense)[:, None]).sum(0) - goals, rcond=1e-9)[0])
    assert np.allclose(rate, dense, atol=1e-6)
    assert np.allclose((one_hot * (n * rate)[:, None]).sum(0), of_groups, atol=1e-3 * n.sum())
    held = {r.group: r for r in m.groups.collect()}
    assert sorted(held) == names and np.allclose([held[g].goal for g in names], of_groups)


def test_goals_that_cannot_be_met_are_told(spark):
    rows = [(i, ("red" if i % 4 else "blue") + " text", "one" if i % 4 else "two") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part string")
    labels = docs.select("doc_id", F.expr("split(text, ' ')[0]").alias("domain"))
    with pytest.warns(UserWarning, match="missed"):
        m = mixing.mix(docs, labels, {"red": 0.1, "blue": 0.9}, groups="part", rounds=3)
    assert m.missed > 0.1 and m.rounds == 3
    assert mixing.mix(docs.limit(0), labels.limit(0), groups="part").groups is None
    alone = mixing.mix(docs, labels.limit(0), groups="part", grow=True)
    assert alone.goals == {} and alone.missed < 1e-6 and alone.rows.where("copies < 1").count() == 0
    assert alone.groups.where("abs(now - goal) > 1e-3 * goal").count() == 0


def test_more_languages_than_domains_may_be(spark):
    rows = [(i, f"w{i % 40} text", f"l{i % 40}") for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(160)] + [(0, None, 0)], "doc_id long, quality int, toxic int")
    found = {r.domain for r in queries.quality_labels(docs, labels).collect()}
    assert len({d.split("/")[0] for d in found}) == 32 and len(found) <= mixing.MOST_DOMAINS


def test_mixing_plan_has_no_python(spark, small, capsys):
    docs, m = mixed(spark, small)
    mixing.repeat(docs, m).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def test_pipeline_stages(spark, small):
    docs = queries.table(spark, small, "documents")
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, corpus_pipeline.written(stage(spark, docs, small), f"test-{k}")
        if k < 4:
            assert docs.columns == columns
        ids = lambda d: {r.doc_id for r in d.select("doc_id").collect()}
        assert ids(docs) <= ids(before)
        if k in (1, 3, 4):
            assert ids(docs) == ids(before)
        if k == 1:
            assert docs.where("n_chars <> char_length(text)").count() == 0
    assert docs.where("not round_trip").count() == 0


def test_the_mixing_stage_goes_by_what_texts_say(spark, tmp_path):
    """One source and no language named: only the classifier tells the rare texts, which are to occur more often."""
    rows = [(i, ("der hund und die katze " if i % 10 == 0 else "the dog and the cat ") * 3 + f"n{i}", "de" if i % 10 == 0 else "en") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("source", F.lit("s"))
    labels = docs.where("doc_id < 200").select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    unnamed = docs.withColumn("lang", F.when(F.col("doc_id") < 200, F.col("lang")))
    left = Counter(r.doc_id for r in corpus_pipeline.mixed(spark, unnamed, str(tmp_path)).collect())
    assert len(left) == 600
    rare, common = [np.mean([left[i] for i in range(600) if (i % 10 == 0) == x]) for x in (True, False)]
    assert 1.5 < rare / common < 2.5 and np.isclose(common, 1, atol=0.1)


def test_stages_bear_odd_rows(spark, small, odd, none):
    for given in (odd.select("doc_id", "text", "lang", "source", "n_chars"), none):
        docs = given
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.written(stage(spark, docs, small), "test-odd")
        assert (docs.count() > 0) == (given.count() > 0)


def test_one_of_each_group_stays(spark, small):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(9, text), (4, text + " x"), (7, text), (7, text), (None, text), (1, "short"), (2, None), (2, None), (3, "other words that stand alone here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = corpus_pipeline.one_of_each_group(spark, docs, small).collect()
    assert sorted((r.doc_id for r in left), key=str) == [1, 2, 2, 3, 4, None]
