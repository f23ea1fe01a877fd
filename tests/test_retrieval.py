"""Retrieval against brute force, context, guards, evaluation."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltbed.functions.text import word_line, words
from siltbed.operators import answers, pivots, postings, ranking, retrieval

HIT = "question_id INT, rank INT, text STRING, source_url STRING"


def vectors(seed, n, prefix):
    rng = np.random.default_rng(seed)
    # A third of the rows and more belong to one corpus.
    return [
        (f"{prefix}{i}", "big" if i % 3 else f"c{i % 5}", "g", [float(x) for x in rng.normal(size=8)])
        for i in range(n)
    ]


def best(questions, chunks, score, k):
    out = set()
    for q in questions:
        scored = [(round(score(q, c), 6), c[0]) for c in chunks if c[1:3] == q[1:3]]
        for rank, (s, c) in enumerate(sorted(scored, key=lambda x: (-x[0], x[1]))[:k], 1):
            out.add((q[0], c, s, rank))
    return out


def cosine(q, c):
    a, b = np.array(q[3]), np.array(c[3])
    size = np.linalg.norm(a) * np.linalg.norm(b)
    return float(a @ b / size) if size else 0.0


@pytest.mark.parametrize("blocks", [{}, {"pivots": 3, "block": 2}, {"pivots": 50, "block": 7}])
def test_vector_search_is_exact(spark, monkeypatch, blocks):
    monkeypatch.setattr(pivots, "QUESTIONS", 3 if blocks else 256)
    qs, cs = vectors(1, 25, "q"), vectors(2, 300, "c")
    ddl = "{} STRING, corpus_id STRING, generation STRING, embedding ARRAY<FLOAT>"
    as32 = lambda rows: [(*r[:3], [float(np.float32(x)) for x in r[3]]) for r in rows]
    qs, cs = as32(qs), as32(cs)
    cs += [(f"same{i}", *cs[i][1:]) for i in range(20)]  # ties
    cs += [("zero", "big", "g", [0.0] * 8), ("narrow", "big", "g", [1.0, 2.0])]
    odd = [("none", "big", "g", None), ("empty", "big", "g", []), ("hole", "big", "g", [1.0, None]), ("nan", "big", "g", [math.nan] * 8)]
    chunks = spark.createDataFrame(cs + odd, ddl.format("chunk_id")).repartition(6)
    assert {r.chunk_id for r in retrieval.without_vector(chunks).collect()} == {r[0] for r in odd}
    index = retrieval.vector_index(chunks, **blocks)
    found = retrieval.retrieve_vector(spark.createDataFrame(qs + odd, ddl.format("question_id")), index, 5)
    cs = [c for c in cs if c[0] != "narrow"]
    rows = {(r.question_id, r.chunk_id, r.score, r["rank"]) for r in found.collect()}
    assert rows == best(qs, cs, cosine, 5)


def bm25_of(cs):
    """The weight of a question for a chunk, from all chunks of its corpus."""
    stats = {}
    for name in {c[1] for c in cs}:
        docs = [(c[3] or "").split() for c in cs if c[1] == name]
        stats[name] = (len(docs), sum(map(len, docs)) / len(docs), Counter(w for d in docs for w in set(d)))

    def bm25(q, c):
        n, mean, df = stats[q[1]]
        words_, total = (c[3] or "").split(), 0.0
        for term in set(q[3].lower().split()):
            tf = words_.count(term)
            if tf:
                idf = math.log(1 + (n - df[term] + 0.5) / (df[term] + 0.5))
                total += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words_) / mean))
        return total

    return bm25


@pytest.mark.parametrize("block", [256, 4])
def test_keyword_search_is_exact(spark, block):
    rng = random.Random(3)
    words = ["the"] * 12 + [f"w{i}" for i in range(30)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    cs = [(i, "big" if i % 3 else "small", "g", text(rng.randrange(3, 40))) for i in range(90)]
    qs = [(i, "big" if i % 2 else "small", "g", text(4).upper()) for i in range(12)] + [(99, "big", "g", "absent!")]
    cs += [(200, "big", "g", None), (201, "big", "g", ""), (202, "small", "g", " \n ")]
    bm25 = bm25_of(cs)
    found = retrieval.retrieve_keyword(
        spark.createDataFrame(qs, "question_id INT, corpus_id STRING, generation STRING, text STRING"),
        retrieval.posting_index(
            spark.createDataFrame(cs, "chunk_id INT, corpus_id STRING, generation STRING, text STRING").repartition(5), block
        ), 4,
    )
    expected = {r for r in best(qs, cs, bm25, 4) if r[2] > 0}
    assert {(r.question_id, r.chunk_id, r.score, r["rank"]) for r in found.collect()} == expected


def fused(qs, cs, k):
    """Reciprocal ranks of whole rankings, added up."""
    bm25, out = bm25_of([(c[0], c[1], c[2], c[4]) for c in cs]), set()
    for q in qs:
        total: dict = {}
        own = [c for c in cs if c[1:3] == q[1:3]]
        legs = [
            [(round(cosine(q, c), 6), c[0]) for c in own if c[3] is not None and q[3] is not None],
            [(s, c[0]) for c in own if (s := round(bm25((*q[:3], q[4] or ""), (*c[:3], c[4])), 6)) >= 1e-6],
        ]
        for leg in legs:
            for rank, (_, c) in enumerate(sorted(leg, key=lambda x: (-x[0], x[1])), 1):
                total[c] = total.get(c, 0.0) + 1 / (60 + rank)
        ranked = sorted(((round(s, 6), c) for c, s in total.items()), key=lambda x: (-x[0], x[1]))
        out |= {(q[0], c, s, rank) for rank, (s, c) in enumerate(ranked[:k], 1)}
    return out


QUESTION = "question_id INT, corpus_id STRING, generation STRING, embedding ARRAY<DOUBLE>, text STRING"


def searched(spark, qs, cs, k):
    chunks = spark.createDataFrame(cs, QUESTION.replace("question_id", "chunk_id")).repartition(4)
    found = retrieval.retrieve_hybrid(
        spark.createDataFrame(qs, QUESTION), retrieval.vector_index(chunks, 4, 16), retrieval.posting_index(chunks, 8), k
    )
    return {(r.question_id, r.chunk_id, r.score, r["rank"]) for r in found.collect()}


@pytest.mark.parametrize("k", [1, 4])
def test_hybrid_fuses_whole_rankings(spark, k):
    rng, words = random.Random(9), [f"w{i}" for i in range(12)]
    vector = lambda: [rng.gauss(0, 1) for _ in range(5)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    cs = [(i, "big" if i % 4 else "c", "g", vector() if i % 7 else None, text(6) if i % 5 else None) for i in range(500)]
    qs = [(i, "big", "g", vector(), text(2)) for i in range(8)]
    qs += [(20, "c", "g", None, text(2)), (21, "big", "g", vector(), None), (22, "none", "g", vector(), "w1"), (23, "c", "g", None, None)]
    assert searched(spark, qs, cs, k) == fused(qs, cs, k)


def test_a_chunk_far_down_in_both_legs_can_win(spark):
    """Ranks 1 to 10 of each leg are last in the other; the chunk at rank 11 in both legs is the best."""
    n = 400
    circle = lambda degrees: [math.cos(math.radians(degrees)), math.sin(math.radians(degrees))]
    turn = {i: i + 1 for i in range(10)} | {10: 11} | {11 + i: 150 + i / 10 for i in range(10)}
    turn |= {i: 20 + i / 10 for i in range(21, n)}
    often = {11 + i: 60 - i for i in range(10)} | {10: 40} | {i: 1 for i in range(10)} | {i: 30 for i in range(21, n)}
    cs = [(i, "c", "g", circle(turn[i]), " ".join(["hit"] * often[i] + ["pad"] * (70 - often[i]))) for i in range(n)]
    qs = [(1, "c", "g", circle(0), "hit")]
    found = searched(spark, qs, cs, 4)
    assert found == fused(qs, cs, 4)
    assert [c for _, c, s, r in found if r == 1] == [10] and max(s for _, _, s, _ in found) == round(2 / 71, 6)


@pytest.mark.parametrize("k", [1, 4, 10, 100])
def test_no_chunk_below_the_depth_can_win(k):
    d = retrieval.sure_depth(k)
    assert round(2 / (60 + d + 1), 6) < round(1 / (60 + k), 6) and d < 3 * (k + 60)


def test_snapshot_guard(spark):
    rows = [("c", "g", "t", "u"), ("c", "old", "t", "u"), ("d", "g", "t", "u"), ("c", "g", "", "u"), ("c", "g", "t", None)]
    hits = spark.createDataFrame(rows, "corpus_id STRING, generation STRING, text STRING, source_url STRING")
    assert retrieval.snapshot_guard(hits, "c", "g").count() == 1


@pytest.mark.parametrize(
    "url,allowed",
    [
        ("https://en.wikipedia.org/wiki/A", True), ("https://EN.Wikipedia.org/wiki/A", True),
        ("http://en.wikipedia.org/wiki/A", False), ("https://evil.test/", False),
        ("https://github.com/a/b", True), ("projectdoc:///docs/a/b.md", True),
        ("projectdoc:///docs/../b.md", False), ("projectdoc:///other/b.md", False),
        ("projectdoc://host/docs/b.md", False), ("projectdoc:///docs/b.md?x=1", False),
        ("projectdoc:///docs/b.md#x", False), ("projectdoc:///docs/%62.md", True), ("not a url", False), (None, False),
    ],
)
def test_allowed_sources(spark, url, allowed):
    row = spark.range(1).select(answers.allowed_source(F.lit(url).cast("string")).alias("ok")).first()
    assert row.ok == allowed


def budgeted(rows, max_sources=8, source_chars=2400, total=10000):
    out, size = [], 0
    for rank, text, url in sorted(rows)[:max_sources]:
        if not url.startswith("https://github.com"):
            continue
        piece = text[: min(source_chars, total - size)]
        if not piece:
            break
        size += len(piece)
        out.append((len(out) + 1, rank, piece))
    return out


def test_context_matches_the_walk(spark):
    rng = random.Random(5)
    rows = [
        (q, rank, "x" * rng.choice([0, 10, 900, 2400, 5000]) if q % 4 == 0 else "y" * rng.randrange(1, 4000),
         rng.choice(["https://github.com/a", "https://evil.test/", "https://github.com/b"]))
        for q in range(40) for rank in rng.sample(range(1, 30), 12)
    ]
    found = answers.context_budget(spark.createDataFrame(rows, HIT)).orderBy("question_id", "source_id").collect()
    for q in range(40):
        expected = budgeted([r[1:] for r in rows if r[0] == q])
        assert [(r.source_id, r["rank"], r.text) for r in found if r.question_id == q] == expected


@pytest.mark.parametrize(
    "text,language",
    [
        ("Що це таке, що є", "Ukrainian"), ("Что это такое", "Russian"), ("WHAT is this", "English"),
        ("somewhat", "the language of the question"), ("Qué es esto", "the language of the question"),
        ("éis", "the language of the question"), ("(is)", "English"),
    ],
)
def test_question_language(spark, text, language):
    assert spark.range(1).select(answers.question_language(F.lit(text)).alias("l")).first().l == language


@pytest.mark.parametrize(
    "text,summary,refused",
    [
        ("Why was this edited by editors?", True, True), ("Why was this edited by editors?", False, False),
        ("What is the REASON for edits of the page?", False, True), ("Why is the sky blue?", True, False),
        ("Почему сделали ПРАВКУ", True, True), ("Зачем редактировали статью", False, True),
        ("Who made the revisions of articles?", True, False),
    ],
)
def test_motive_guard(spark, text, summary, refused):
    guard = answers.motive_guard(F.lit(text), F.lit(summary))
    assert spark.range(1).select(guard.alias("g")).first().g == refused


def test_evaluation(spark):
    ddl = (
        "name STRING, supported BOOLEAN, answered BOOLEAN, expected ARRAY<STRING>, any_of ARRAY<STRING>, "
        "terms ARRAY<STRING>, found_sources ARRAY<STRING>, answer STRING, answer_language STRING"
    )
    good = dict(supported=True, answered=True, expected=["a"], any_of=[], terms=["EaRth"],
                found_sources=["a", "b"], answer="On earth", answer_language="en")
    cases = {
        "good": {}, "unsupported": {"answered": False}, "missing": {"expected": ["a", "z"]},
        "any": {"any_of": ["z", "b"]}, "no_any": {"any_of": ["z"]}, "term": {"terms": ["mars"]},
        "script": {"answer": "earth Ё"}, "ru_short": {"answer_language": "ru"},
        "ru": {"answer_language": "ru", "answer": "earth на русском языке"}, "free": {"answer_language": None, "answer": "Ё earth"},
        "none": {"answer": None},
    }
    names = [c.split()[0] for c in ddl.split(", ")]
    rows = [tuple({**good, **c, "name": n}[k] for k in names) for n, c in cases.items()]
    judged = answers.eval_pass(spark.createDataFrame(rows, ddl))
    passed = {r.name for r in judged.filter("passed").collect()}
    assert passed == {"good", "any", "ru", "free"}
    totals = answers.eval_totals(judged).first()
    assert (totals.passed, totals.cases) == (4, len(cases))


def kept_rows(monkeypatch):
    """Names and row counts of the tables that a search keeps."""
    kept, stored = {}, ranking.stored

    def counted(rows, purpose):
        table = stored(rows, purpose)
        kept[purpose] = table.count()
        return table

    for module in (ranking, pivots, postings):
        if hasattr(module, "stored"):
            monkeypatch.setattr(module, "stored", counted)
    return kept


def test_vector_search_keeps_no_row_per_question_and_block(spark, monkeypatch):
    kept = kept_rows(monkeypatch)
    rows = [(i, "c", "g", [math.cos(i), math.sin(i)]) for i in range(300)]
    ddl = "{} INT, corpus_id STRING, generation STRING, embedding ARRAY<DOUBLE>"
    index = retrieval.vector_index(spark.createDataFrame(rows, ddl.format("chunk_id")), 8, 1)
    found = retrieval.retrieve_vector(spark.createDataFrame(rows[:100], ddl.format("question_id")), index, 1)
    assert {(r.question_id, r.chunk_id) for r in found.collect()} == {(i, i) for i in range(100)}
    assert max(kept.values()) <= len(rows)


def test_keyword_search_keeps_no_row_per_posting(spark, monkeypatch):
    kept = kept_rows(monkeypatch)
    rows = [(i, "c", "g", " ".join(f"w{(i * j) % 41}" for j in range(1, 40)) + f" own{i}") for i in range(1, 100)]
    ddl = "{} INT, corpus_id STRING, generation STRING, text STRING"
    chunks = spark.createDataFrame(rows, ddl.format("chunk_id"))
    asked = spark.createDataFrame([(i, "c", "g", f"own{i}") for i in range(1, 20)], ddl.format("question_id"))
    found = retrieval.retrieve_keyword(asked, chunks, 1)
    assert {(r.question_id, r.chunk_id) for r in found.collect()} == {(i, i) for i in range(1, 20)}
    assert max(kept.values()) <= len(rows)


def test_words_of_one_line_are_the_words(spark):
    texts = ["A b,c__D", " ", "", None, "Éa ß٣ x\n\ty-z", "--", "İi ǅ ⅷ"]
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING")
    for line, listed in rows.select(word_line(F.col("t")), words(F.col("t"))).collect():
        assert line.split(" ") == (listed or [""])


def test_hybrid_search_weighs_the_words_of_its_questions_once(spark, monkeypatch):
    kept, stored = [], ranking.stored

    def named(rows, purpose):
        kept.append(purpose)
        return stored(rows, purpose)

    monkeypatch.setattr(postings, "stored", named)
    cs = [(i, "c", "g", [math.cos(i), math.sin(i)], f"w{i % 5}") for i in range(30)]
    assert searched(spark, cs[:2], cs, 1) == fused(cs[:2], cs, 1)
    assert kept.count("question-terms") == 1
