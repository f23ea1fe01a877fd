"""The pipeline against a plain chain of its stages, row for row, on a small table."""

import hashlib
import random
from collections import defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from siltbed.llm import quality_model, queries
from siltbed.llm.common import RollingHash, joined

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
DDL = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed=3):
    """Good and bad pages, banners, copies and near copies, repeated rows, empty and NULL texts."""
    rng = random.Random(seed)
    good = lambda n: " ".join(rng.choice([f"word{i}" for i in range(500)]) for _ in range(n)).capitalize() + "."
    bad = lambda n: "".join(rng.choice("@#$%&*!!!<>{}[]0123456789 ") for _ in range(n * 6))
    banner, rights = "Subscribe to our letter, it is free.", "Top"
    texts = [good(rng.randrange(5, 120)) for _ in range(130)] + [bad(rng.randrange(5, 90)) for _ in range(60)]
    texts = [f"{banner}\n{t}\n{rights}" if i % 4 == 0 else t for i, t in enumerate(texts)]
    long = good(90)
    texts += [long] * 25 + [" ".join(long.split()[:-k]) for k in range(1, 9)]
    texts += ["", " \n ", None, "a b c", "A b c", f"{banner}\n{rights}", good(3000)]
    rows = [(i, t, ("en", "de", "fr", "es", None)[i % 5], f"src{i % 14}" if i % 17 else None, len(t or "")) for i, t in enumerate(texts)]
    return rows + [rows[3], rows[3], (3, good(40), "en", "src2", 7), (None, good(30), "en", "src1", 3), (None, long, "de", "src2", 3)]


def labels(rows):
    return [(k, int("@" not in t and "#" not in t)) for k, t, *_ in rows if k is not None and t and k % 3 == 0]


def spread_lines(rows):
    sites, copies = defaultdict(set), defaultdict(set)
    for _, text, _, source, _ in rows:
        if text is not None and source is not None:
            copies[text].add(source)
            for line in text.split("\n"):
                sites[line].add(source)
    out = []
    for key, text, lang, source, n in rows:
        if text is not None and len(copies[text]) < queries.MIN_SITES:
            lines = text.split("\n")
            left = [x for x in lines if not x or len(sites[x]) < queries.MIN_SITES]
            if len(left) < len(lines):
                text, n = "\n".join(left), len("\n".join(left))
        out.append((key, text, lang, source, n))
    return out


def one_of_each_group(rows):
    def shingles(text):
        raw = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = [w for w in raw.replace("\n", " ").replace("\t", " ").split(" ") if w]
        return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()

    seen = {}
    for row in rows:  # rows equal in key and text are one document, where they have a key
        seen.setdefault((row[0], row[1] or "") if row[0] is not None else id(row), row)
    sets = [shingles(r[1]) for r in seen.values()]
    group = list(range(len(sets)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                group[root(i)] = root(j)
    members = defaultdict(list)
    for i, row in enumerate(seen.values()):
        members[root(i) if sets[i] else ("empty", i)].append(row)
    hashed = lambda r: (r[0] is None, r[0] or 0)
    return {frozenset((r[0], r[1]) for r in own if hashed(r) == min(map(hashed, own))): own for own in members.values()}


def test_pipeline_equals_a_plain_chain(spark, tmp_path, monkeypatch):
    rows = corpus()
    folder = tmp_path / "tables"
    folder.mkdir()
    docs = spark.createDataFrame(rows, DDL)
    docs.coalesce(1).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame([(k, q, 0) for k, q in labels(rows)], "doc_id long, quality int, toxic int").write.parquet(
        str(folder / "labels.parquet")
    )
    kept = {}
    real = corpus_pipeline.work_table

    def watch(frame, purpose):
        table = real(frame, purpose)
        if purpose.startswith("stage-"):
            kept[purpose.removeprefix("stage-")] = [tuple(r) for r in table.collect()]
        return table

    monkeypatch.setattr(corpus_pipeline, "work_table", watch)
    found = corpus_pipeline.run(spark, str(folder)).toPandas()
    text = lambda part: sorted(map(str, part))

    # The model's own score decides, document by document.
    model = quality_model.fit(docs, spark.read.parquet(str(folder / "labels.parquet")))
    roll, accepted = RollingHash(), []
    for row in rows:
        bags, features = quality_model.passages(*joined([(row[1] or "").encode()]), roll)
        score = np.round(model.score(bags, features.astype("<f4").astype(float), 1)[0], 6)
        if score >= quality_model.THRESHOLD:
            accepted.append(row)
    assert text(kept["quality-classifier"]) == text(accepted) and 50 < len(accepted) < len(rows)
    wrong = [r[0] for r in accepted if r[1] and ("@" in r[1] or "#" in r[1]) and r[0] and r[0] % 3]
    assert len(wrong) < 10

    cleaned = spread_lines(accepted)
    assert text(kept["line-dedup"]) == text(cleaned)

    groups = one_of_each_group(cleaned)
    left = kept["n-gram-Jaccard-join"]
    assert len(left) == len(groups)
    told = {(r[0], r[1]): r for r in cleaned}
    for row in left:
        assert row in cleaned and sum((row[0], row[1]) in best for best in groups) >= 1, row
    assert len({next(i for i, best in enumerate(groups) if (r[0], r[1]) in best) for r in left if r[0] is not None}) == sum(
        r[0] is not None for r in left
    ) and told

    con = duckdb.connect()
    con.register("documents", pd.DataFrame(left, columns=COLUMNS).astype({"doc_id": "Int64"}))
    copies = con.execute(f"SELECT doc_id, copies FROM ({queries.mix_sql()})").fetchall()
    want = defaultdict(int)
    for key, n in copies:
        want[key] += n
    mixed = kept["mixing-sources"]
    have = defaultdict(int)
    for row in mixed:
        assert row in left
        have[row[0]] += 1
    assert {k: n for k, n in want.items() if n} == dict(have)

    library = tokenizers.Tokenizer.from_file(queries.vocabulary())
    library.no_truncation()
    library.no_padding()
    told = []
    for row in mixed:
        ids = library.encode(row[1] or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        told.append((row[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    shown = [(None if pd.isna(k) else int(k), int(n), a, b) for k, n, a, b in found.itertuples(index=False)]
    assert text(shown) == text(told) and len(told) > 20


def test_pipeline_of_nothing(spark, tmp_path):
    for name, ddl in (("documents", DDL), ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], ddl).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", ["_h", "_kid", "hilbert", "shard", "_rid", "copies2"])
def test_stages_carry_further_columns(spark, documents, name):
    """Columns that the stages do not use pass through, whatever a stage calls its own inside."""
    docs = documents(["one text here", "one text here", "another text there", None]).withColumn(name, F.lit("x"))
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        docs = stage(spark, docs, "")
        assert name in docs.columns
    assert docs.filter(F.col(name) != "x").count() == 0
