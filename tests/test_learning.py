"""The learnt tagger and the training batches against plain Python."""

import math
import re

import pytest
from pyspark.sql import functions as F

from hirelake import schemas
from hirelake.operators import batches, enrich, tagging, text_ml
from hirelake.plans import load

TOKEN = re.compile(r"[\w+#]+[^\s\w+#]*")
TOOLS = ("Spark", "Go", "Power BI", "SQL Server", "SQL")
TRAIN = [
    (1, "We use Spark and SQL Server daily. Go is fine, so go on. Power BI too!"),
    (2, "Spark Spark Power BI. A spark of joy; the power of SQL? go home. Go Go Go"),
    (3, "SQL SQL Server Spark! Server power bi server sql"),
    (4, None),
    (5, ""),
    (6, "nothing to see here. Nothing at all"),
    (None, "Spark without a number"),
]
DEV = [
    (11, "Go on with spark and Power BI. Go SQL Server SQL bi bi bi, server of power"),
    (12, "unknown words only"),
    (13, "spark"),
    (14, "go go go power bi sql server. power. BI! spark sql sql server go"),
    (15, None),
    (16, ""),
]


def tokens(text):
    raw = TOKEN.findall(text or "")
    words = [re.match(r"[\w+#]+", t)[0].lower() for t in raw]
    return words, [i == 0 or bool(re.search("[.!?]", raw[i - 1])) for i in range(len(raw))]


def learn(texts, spans):
    """Tags of all tokens, one by one, and the log weights of the model."""
    named, spans = {}, [s for s in spans if s[0] is not None]
    for i, start, n, term in spans:
        for k, word in enumerate(term.split(" ")):
            named[i, start + k] = ("B" if k == 0 else "I", word)
    inside = {w for _, w in named.values()}
    moves, seen = {}, {}
    for i, text in texts:
        if i is None:
            continue
        before = None
        for pos, (word, first) in enumerate(zip(*tokens(text))):
            tag = named.get((i, pos), ("O",))[0]
            moves["S" if first else before, tag] = moves.get(("S" if first else before, tag), 0) + 1
            seen[tag, word] = seen.get((tag, word), 0) + 1
            before = tag
    after = {b: sum(moves.get((b, t), 0) for t in "OBI") + 3 for b in "SOBI"}
    steps = {(b, t): math.log((moves.get((b, t), 0) + 1) / after[b]) for b in "SOBI" for t in "OBI"}
    total = {t: sum(n for (tag, _), n in seen.items() if tag == t) + len(inside) + 1 for t in "OBI"}
    words = {w: {t: math.log((seen.get((t, w), 0) + 1) / total[t]) for t in "OBI"} for w in inside}
    return steps, words


def decode(text, steps, model):
    """Viterbi over all tokens of each sentence; words that names never have can only be O."""
    words, firsts = tokens(text)
    tags = []
    sentences = [i for i, f in enumerate(firsts) if f] + [len(words)]
    for a, b in zip(sentences, sentences[1:]):
        ways = {"S": (0.0, "")}
        for word in words[a:b]:
            emit = model.get(word, {"O": 0.0})
            ways = {
                t: max(((s + steps[p, t] + e, -"SOBI".index(p), path + t) for p, (s, *_, path) in ways.items()))
                for t, e in emit.items()
            }
            ways = {t: (s, path) for t, (s, _, path) in ways.items()}
        tags += max((s, -"OBI".index(t), path) for t, (s, path) in ways.items())[2]
    spans, k = [], 0
    while k < len(tags):
        n = 1
        if tags[k] != "O":
            while k + n < len(tags) and tags[k + n] == "I" and not firsts[k + n]:
                n += 1
            spans.append((k, n, " ".join(words[k : k + n])))
        k += n
    return spans


@pytest.fixture(scope="module")
def learnt(spark):
    train = spark.createDataFrame(TRAIN, "id long, text string")
    gold = enrich.tagged_spans(train, "id", "text", (), TOOLS)
    spans = [tuple(r) for r in gold.collect()]
    return tagging.fit_tagger(train, gold, "id", "text"), learn(TRAIN, spans), spans


def test_weights_equal_counts_by_hand(learnt):
    tagger, (steps, words), spans = learnt
    assert (2, 2, 2, "power bi") in spans and (1, 4, 2, "sql server") in spans
    assert tagger.steps == pytest.approx(steps)
    found = {r["word"]: (r["o"], r["b"], r["i"]) for r in tagger.words.collect()}
    assert set(found) == set(words)
    for word, weights in words.items():
        assert found[word] == pytest.approx((weights["O"], weights["B"], weights["I"]))


@pytest.mark.parametrize("looked_up", [4096, 1])
def test_tags_equal_viterbi_over_whole_sentences(spark, learnt, monkeypatch, looked_up):
    monkeypatch.setattr(tagging, "LOOKED_UP", looked_up)  # few words are looked for in place, many joined
    tagger, (steps, words), _ = learnt
    for texts in (DEV, [t for t in TRAIN if t[0]]):
        docs = spark.createDataFrame(texts, "id long, text string")
        found = sorted(tuple(r) for r in tagger.spans(docs, "id", "text").collect())
        assert found == sorted((i, *s) for i, text in texts for s in decode(text, steps, words))
    assert any(n == 2 for _, _, n, _ in found)


def test_stored_tagger_is_the_same(spark, learnt, tmp_path):
    tagger, docs = learnt[0], spark.createDataFrame(DEV, "id long, text string")
    tagger.save(f"{tmp_path}/model")
    again = tagging.Tagger.load(spark, f"{tmp_path}/model")
    assert again.steps == tagger.steps
    expected = sorted(map(tuple, tagger.spans(docs, "id", "text").collect()))
    assert sorted(map(tuple, again.spans(docs, "id", "text").collect())) == expected


def test_no_examples(spark):
    none = spark.createDataFrame([], "id long, text string")
    tagger = tagging.fit_tagger(none, enrich.tagged_spans(none, "id", "text", (), TOOLS), "id", "text")
    assert tagger.spans(spark.createDataFrame(DEV, "id long, text string"), "id", "text").count() == 0


def test_texts_are_read_once_for_names_and_once_for_words(spark):
    reads = spark.sparkContext.accumulator(0)

    def read(text):
        reads.add(1)
        return text

    train = spark.createDataFrame(TRAIN, "id long, text string")
    docs = train.select("id", F.udf(read, "string").asNondeterministic()("text").alias("text"))
    tagging.fit_tagger(docs, enrich.tagged_spans(docs, "id", "text", (), TOOLS), "id", "text")
    assert reads.value <= 2 * len(TRAIN)


def sizes(start, stop, compound):
    size = start
    while True:
        yield min(size, stop)
        size *= compound


@pytest.mark.parametrize("start,stop,compound", [(100, 1000, 1.001), (10, 50, 1.5), (7, 7, 1.0), (5, 1000, 1.0), (3, 9, 2.0)])
def test_batches_equal_a_running_schedule(spark, start, stop, compound):
    numbers = [*range(0, 3000, 7), *range(3_000, 3_000_000, 71_993)]
    found = spark.createDataFrame([(n,) for n in numbers], "w long")
    got = [r[0] for r in found.select(batches.batch_at(found["w"], start, stop, compound)).collect()]
    expected, schedule, batch, ends = [], sizes(start, stop, compound), -1, 0.0
    for n in numbers:
        while ends <= n + 1e-6:
            ends, batch = ends + next(schedule), batch + 1
        expected.append(batch)
    assert got == expected


def test_order_prefix_sums_and_oversize(spark):
    import hashlib

    docs = [(k, " ".join(["w"] * (k * 37 % 23))) for k in range(2_000)] + [(None, None), (5_000, ""), (5_001, "x " * 5_000)]
    table = spark.createDataFrame(docs, "id long, text string")
    key = lambda seed, epoch, i: hashlib.md5(f"{seed}:{epoch}:{'' if i is None else i}".encode()).hexdigest()
    for seed, epoch in ((0, 0), (3, 1)):
        found = {r["id"]: (r["n_words"], r["words_before"]) for r in batches.words_before(table, "id", "text", seed, epoch).collect()}
        total = 0
        for i, text in sorted(docs, key=lambda d: key(seed, epoch, d[0])):
            n = len((text or "").split())
            assert found[i] == (n, total)
            total += n
    whole = batches.training_batches(table, "id", "text")
    assert whole.count() == len(docs) and whole.where("id = 5001").count() == 1
    fitting = batches.training_batches(table, "id", "text", discard_oversize=True)
    assert fitting.where("id = 5001").count() == 0 and fitting.count() == len(docs) - 1


def test_no_window_sees_all_texts(spark):
    table = spark.createDataFrame([(1, "a b")], "id long, text string")
    plan = batches.training_batches(table, "id", "text")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window [" in line]
    assert windows and all("_block" in w or "_span" in w for w in windows)


def test_a_stored_role_model_loads_like_the_one_in_memory(spark, tmp_path):
    examples = [("Data Engineer (Spark)", "Data Engineer"), ("Engineer of data pipelines", "Data Engineer"),
                ("Data Analyst", "Data Analyst"), ("Analyst, business", "Data Analyst"), ("Cook", "Other")]
    spark.createDataFrame(examples, "title string, role string").write.parquet(f"{tmp_path}/examples")
    stored = load.role_model(spark, f"{tmp_path}/model", f"{tmp_path}/examples")
    fitted = text_ml.fit_naive_bayes(spark.read.parquet(f"{tmp_path}/examples"), "title", "role")
    assert (stored.labels, stored.priors, stored.costs) == (fitted.labels, fitted.priors, fitted.costs)
    titles = [(1, "pipelines engineer"), (2, "business analyst"), (3, "cook"), (4, None), (5, "unseen")]
    raw = spark.createDataFrame(titles, "id long, title string")
    columns = ("company", "location", "employment_type", "job_description", "metadata_application_link", "metadata_source")
    raw = raw.selectExpr("*", *[f"'x' AS {c}" for c in columns],
                         "DATE'2024-01-01' AS date_posted", "TIMESTAMP_NTZ'2024-01-02 00:00:00' AS metadata_lastupdated")
    found = []
    for k, model in enumerate((stored, fitted, load.role_model(spark, f"{tmp_path}/model"))):
        load.load_batch(spark, raw, f"{tmp_path}/{k}", "2024-01-02", role_model=model)
        clean = spark.read.parquet(schemas.table_path(f"{tmp_path}/{k}", schemas.CLEAN_JOBS))
        found.append(sorted((r["id"], r["role"]) for r in clean.collect()))
    assert found[0] == found[1] == found[2]
    assert found[0][:3] == [(1, "Data Engineer"), (2, "Data Analyst"), (3, "Other")]
