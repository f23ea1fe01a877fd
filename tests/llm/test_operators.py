"""Operators against brute force on small tables: NULLs, empty and long texts, ties, repeats, empty tables."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from siltbed.llm import (
    bpe, cap_filters, fingerprints, hilbert, line_spread, mixing, parity_join, quality_model, queries,
    suffix_dedup, token_counts,
)
from siltbed.llm.common import BLANK, joined
from siltbed.llm.components import components

WORDS = [f"w{i}" for i in range(400)]
ODD = [None, "", " ", "one", "one", "a\nb\n", "x" * 5000, "ünïcode 　 text 'll 12", "<|endoftext|> end", "\x00\x1f"]


def text_of(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, 90), (90, 95), (7, 7), (None, 3)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {**{i: 1 for i in range(1, 31)}, 90: 90, 95: 90, 100: 90}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hilbert_curve_visits_neighbours():
    cells = np.array([(i, j, k) for i in range(8) for j in range(8) for k in range(8)])
    index = hilbert.hilbert_index(cells, 3)
    assert sorted(index) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("n", [0, 5, 24, 200])
def test_shards_are_even_and_gapless(documents, n):
    docs = documents([(i // 2 if i % 5 else None, f"text {i % 3}") for i in range(n)]).withColumn("_place", F.lit(1))
    rows = hilbert.hilbert_shards(docs, ["lang", "source", "n_chars"], 24, "doc_id").collect()
    counts = Counter(r.shard for r in rows)
    assert len(rows) == n and all(counts.get(s, 0) in (n // 24, n // 24 + (n % 24 > 0)) for s in range(24))
    for shard, size in counts.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(size))
    along = [r.hilbert for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert along == sorted(along)
    with pytest.raises(ValueError):
        hilbert.hilbert_shards(docs.withColumn("Shard", F.lit(1)), ["lang"], 2, "doc_id")


def test_op1_equals_brute_force(spark):
    """The registered query over its table: cells, curve, order and runs, worked out row by row."""
    import zlib

    folder, bits = "/root/testdata/sf0.001", 5
    docs = [r.asDict() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    for r in docs:
        r["size"] = len((r["text"] or "").encode()) + 8
        r["crc"] = zlib.crc32((r["text"] or "").encode())

    def string_cells(name):
        counts, seen, cuts = Counter(r[name] for r in docs if r[name] is not None), 0, []
        total = sum(counts.values())
        for value in sorted(counts):
            before, seen = seen, seen + counts[value]
            if seen < total:
                cuts += [value] * (seen * 2**bits // total - before * 2**bits // total)
        return [0 if r[name] is None else sum(c < r[name] for c in cuts) for r in docs]

    sizes = sorted(r["size"] for r in docs)
    cuts = [sizes[max(0, -(-i * len(sizes) // 2**bits) - 1)] for i in range(1, 2**bits)]
    by_size = [sum(c < r["size"] for c in cuts) for r in docs]
    index = hilbert.hilbert_index(np.array([string_cells("lang"), string_cells("source"), by_size]).T, bits)
    order = sorted(range(len(docs)), key=lambda i: (index[i], docs[i]["crc"], docs[i]["doc_id"]))
    small, more = divmod(len(docs), 24)
    want, at = {}, 0
    for shard in range(24):
        for slot in range(small + (shard < more)):
            r = docs[order[at]]
            want[r["doc_id"]] = (r["size"], r["crc"], "rows", shard, slot, None, int(index[order[at]]))
            at += 1
    found = {r[0]: tuple(r)[1:] for r in queries.R.queries["op1_hilbert_shards"](spark, folder).collect()}
    assert found == want


def test_shards_prune_in_every_dimension(spark, tmp_path):
    """Files written along the curve have narrow ranges, also of strings that begin alike; in key order they have none."""
    rows = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("https://www.site-"), F.lpad((F.col("id") * 7919 % 400).cast("string"), 3, "0")).alias("url"),
        F.element_at(F.array(*map(F.lit, "abcdefgh")), (F.col("id") * 31 % 8 + 1).cast("int")).alias("lang"),
        (F.col("id") * 104729 % 100003).alias("size"),
    )
    dims = ["url", "lang", "size"]
    sharded = hilbert.hilbert_shards(rows, dims, 64, "doc_id")
    hilbert.write_shards(sharded, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 6000 and len(list((tmp_path / "shards").glob("shard=*"))) == 64
    share = {}
    for dim in dims:
        ranges = back.groupBy("shard").agg(F.min(dim).alias("low"), F.max(dim).alias("high")).collect()
        asked = [r[0] for r in rows.select(dim).distinct().orderBy(F.xxhash64(dim)).limit(50).collect()]
        share[dim] = np.mean([[r.low <= v <= r.high for r in ranges] for v in asked])
    assert all(s < 0.5 for s in share.values()), share
    assert share["url"] * share["lang"] * share["size"] < 0.06, share
    # Along one value after the other the slots of a shard are the curve.
    along = [r.hilbert for r in back.filter("shard = 5").orderBy("slot").collect()]
    assert along == sorted(along)


def test_string_cuts_are_whole_strings(spark):
    frame = spark.createDataFrame([(f"https://x/{i:02d}",) for i in range(64)] + [(None,)] * 9 + [("https://x/99",)] * 64, "u string")
    cuts = hilbert.string_cuts(frame, "u", 3)
    assert cuts == [f"https://x/{i}" for i in (15, 31, 47, 63)] and hilbert.string_cuts(frame.filter("u IS NULL"), "u", 3) == []
    even = spark.createDataFrame([(f"https://x/{i:02d}",) for i in range(64)], "u string")
    assert hilbert.string_cuts(even, "u", 2) == ["https://x/15", "https://x/31", "https://x/47"]
    few = spark.createDataFrame([(c,) for c in "abab"], "u string")
    assert hilbert.string_cuts(few, "u", 3) == ["a"] * 4


def test_the_fit_is_bounded(spark, documents, monkeypatch):
    """Rows of one key are one row of the sample, and passages are bounded, too."""
    reached = []
    real = quality_model.train
    monkeypatch.setattr(quality_model, "train", lambda b, f, t: reached.append((len(t), len(f))) or real(b, f, t))
    docs = documents([(i % 5, f"text {i} " * (i + 1)) for i in range(300)] + [(900, "word " * 5000), (None, "x")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(5)] + [(900, 1)], "doc_id long, quality int")
    quality_model.fit(docs, labels, max_training=2)
    quality_model.fit(docs, labels)
    quality_model.fit(docs, labels, max_passages=40)
    assert reached[0][0] == 2 and reached[1][0] <= 6 and reached[2][1] <= 40
    assert reached[1][1] - reached[2][1] >= 0


def brute_removed(texts, length):
    strings = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if strings[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        out.append(bytes(c for c, g in zip(t, gone) if not g))
    return out


def test_suffix_dedup_equals_brute_force(documents):
    rng = random.Random(5)
    passage, other = text_of(rng, 60), text_of(rng, 25)
    texts = [*ODD, passage, passage, text_of(rng, 50) + passage, passage[:210] + text_of(rng, 9), passage[:199], other * 4]
    for _ in range(40):
        cut = rng.randrange(len(passage) - 250)
        texts.append(text_of(rng, rng.randrange(40)) + passage[cut : cut + rng.randrange(190, 250)] + text_of(rng, 5))
    rows = suffix_dedup.drop_repeated_bytes(documents(texts)).collect()
    raw = [(t or "").encode() for t in texts]
    assert {r.doc_id: bytes(r.kept) for r in rows} == dict(enumerate(brute_removed(raw, 200)))
    assert all(sum(s.stop - s.start for s in r.spans) == r.n_bytes - len(r.kept) for r in rows)
    assert suffix_dedup.drop_repeated_bytes(documents([])).count() == 0


def test_fingerprints(documents):
    rng = random.Random(2)
    texts = [*ODD, *(text_of(rng, rng.randrange(1, 300)) for _ in range(60))]
    rows = {r.doc_id: r for r in fingerprints.edit_likeness(documents(texts)).collect()}
    assert len(rows) == len(texts)
    names = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(documents(texts)).collect()}
    error = []
    for i, t in enumerate(texts):
        own, after = t or "", texts[(i + 1) % len(texts)] or ""
        edited = own[: len(own) - len(own) // 2] + after[: len(own) // 2]
        r = rows[i]
        assert r.n_chars == len(own) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == names[i]
        a, b = ([w for w in x.split() if w] for x in (own, edited))
        a, b = Counter(a), Counter(b)
        if i >= len(ODD):
            error.append(sum((a & b).values()) / sum((a | b).values()) - r.near_edited)
    assert rows[3].fingerprint == rows[4].fingerprint and rows[3].near_next == 1.0
    assert abs(np.mean(error)) < 0.03 and np.abs(error).max() < 0.25
    assert fingerprints.edit_likeness(documents([])).count() == 0
    assert fingerprints.edit_likeness(documents([(7, "a b"), (7, "a b"), (None, "c")])).count() == 3


def test_cap_filters_recall_and_edges(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.normal(size=base.shape)
    side -= (side * base).sum(1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    x = np.concatenate([base, 0.955 * base + np.sqrt(1 - 0.955**2) * side, base[:5]])
    rows = [(i, [float(f) for f in v]) for i, v in enumerate(x)]
    rows += [(9000, None), (9001, []), (9002, [0.0] * 64), (9003, [float("nan")] * 64), (9004, [None, 1.0]), (9005, [2.0, 0.0]),
             (9006, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in cap_filters.near_vectors(frame).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    assert len(got) == len(rows)
    found = sum(got[i].n_links for i in range(len(x)))
    assert 0.9 * near.sum() <= found <= near.sum() and all(got[i].n_links <= near[i].sum() for i in range(len(x)))
    assert got[600].component_id == 0 and not got[600].kept
    for i in range(9000, 9005):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[9006].component_id == 9005 and not got[9006].kept
    assert cap_filters.near_vectors(frame.limit(0)).count() == 0


def test_cap_filters_tell_rows_of_one_key_apart(spark):
    """Repeated and NULL keys: links and components follow the vectors, not the keys."""
    def unit(*parts):
        v = np.zeros(64)
        for place, value in parts:
            v[place] = value
        return [float(f) for f in v / np.linalg.norm(v)]

    a, b, c = unit((0, 1)), unit((1, 1)), unit((2, 1))
    near = [unit((k, 1), (9, 0.1)) for k in range(3)]
    rows = [(1, a), (1, b), (2, near[0]), (3, near[1]), (None, c), (4, near[2]), (5, a), (None, unit((20, 1)))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted(map(str, map(tuple, cap_filters.near_vectors(frame).collect())))
    want = [
        (1, 2, 1, True), (1, 1, 1, True), (2, 2, 1, False), (3, 1, 1, False), (None, 1, 4, False), (4, 1, 4, True),
        (5, 2, 1, False), (None, 0, None, False),
    ]
    assert got == sorted(map(str, want))


def brute_near(texts):
    sets = []
    for t in texts:
        raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode())
        words = bytes(32 if BLANK[c] else c for c in raw).split(b" ")
        words = [w for w in words if w]
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return [(len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("crowd", [12, 2])
def test_parity_join_equals_brute_force(documents, monkeypatch, crowd):
    """A low crowd limit sends most sets through the second stage."""
    monkeypatch.setattr(parity_join, "CROWD", crowd)
    rng = random.Random(crowd)
    line = text_of(rng, 30)
    texts = [*ODD, "A b C d", "a B c D", "a b c d e", "a b c d e"]
    for size in (8, 40, 120, 130, 260, 300):
        seed = text_of(rng, size).split()
        texts.append(" ".join(seed).upper())
        for _ in range(12):
            copy = list(seed)
            for _ in range(rng.randrange(0, 2 + size // 25)):
                copy[rng.randrange(size)] = "edited"
            texts.append(" ".join(copy[rng.randrange(1 + size // 12) :]))
    texts += [line + " " + text_of(rng, rng.randrange(2, 40)) for _ in range(60)]
    rows = parity_join.near_documents(documents(texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == dict(enumerate(brute_near(texts)))


def test_parity_join_edges(documents):
    assert parity_join.near_documents(documents([])).count() == 0
    rows = parity_join.near_documents(documents([(None, "a b c"), (3, "a b c"), (3, "a b c"), (5, None)])).collect()
    assert sorted((r.doc_id or -1, r.component_id) for r in rows if r.n_shingles) == [(-1, 3), (3, 3), (3, 3)]


def test_parity_join_tells_texts_of_one_key_apart(documents):
    rng = random.Random(6)
    a, b, c = (text_of(rng, 60) for _ in range(3))
    # Keys 1 and 2 stand on several texts; NULL keys are links of a chain that no other pair closes.
    words = text_of(rng, 100).split()
    chain = [" ".join(words[:80]), " ".join(words[8:88]), " ".join(words[16:96])]
    rows = [(1, a), (1, b), (2, c), (2, a + " more"), (7, b + " more"), (8, c + " more"),
            (20, chain[0]), (None, chain[1]), (21, chain[2]), (None, "x y z"), (None, "x y z"), (3, ""), (3, "")]
    near = parity_join.near_documents(documents(rows)).collect()
    assert sorted(((r.doc_id or 0, r.component_id or 0) for r in near)) == sorted(
        [(1, 1), (1, 1), (2, 2), (2, 1), (7, 1), (8, 2), (20, 20), (0, 20), (21, 20), (0, 0), (0, 0), (3, 3), (3, 3)]
    )
    groups = {}
    for r in parity_join.near_sets(documents(rows)).filter("size > 0").collect():
        groups.setdefault(r.component, []).append(r.id or 0)
    assert sorted(map(sorted, groups.values())) == [[0, 0], [0, 20, 21], [1, 2], [1, 7], [2, 8]]
    left = corpus_pipeline.near_duplicates(None, documents(rows), "").collect()
    assert sorted(((r.doc_id or 0, r.text) for r in left)) == sorted(
        [(1, a), (1, b), (2, c), (20, chain[0]), (0, "x y z"), (3, "")]
    )


def test_quality_model(spark, documents):
    rng = random.Random(4)
    good = [text_of(rng, rng.randrange(1, 150)) for _ in range(150)]
    bad = [" ".join(w + "$$$" for w in text_of(rng, 90).split()) for _ in range(50)]
    texts = [*good, *bad, None, ""]
    docs = documents(texts)
    labels = [(i, int(i < 150), 0) for i in range(200)] + [(3, None, 0), (None, 1, 0), (4, 1, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    scored = quality_model.quality_scores(docs, quality_model.fit(docs, labels))
    rows = {r.doc_id: r for r in scored.withColumn("out", quality_model.held_out("doc_id")).collect()}
    held = [r for i, r in rows.items() if r.out and i < 200]
    assert len(rows) == 202 and np.mean([r.predicted == (r.doc_id < 150) for r in held]) > 0.95
    assert rows[200].score == rows[201].score and 0 <= rows[200].score <= 1
    empty = quality_model.fit(docs, labels.limit(0))
    assert {r.score for r in quality_model.quality_scores(docs, empty).collect()} == {0.5}
    assert quality_model.quality_scores(documents([]), empty).count() == 0


def test_bpe_and_token_counts_equal_the_library(documents):
    rng = random.Random(6)
    bits = ["a", "'", "s", " ", "\n", "é", "1", "!", "<|endoftext|>", "中", "　", "'ll", "  ", "\x00", "😀", "zq"]
    texts = [*ODD, *("".join(rng.choice(bits) for _ in range(rng.randrange(80))) for _ in range(400))]
    tokenizer = Tokenizer.from_file(queries.vocabulary())
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    ids = bpe.bpe_encode(documents(texts), queries.vocabulary())
    rows = bpe.bpe_decode(ids, queries.vocabulary()).collect()
    for r in rows:
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == want[r.doc_id] and r.n_tokens == len(want[r.doc_id])
        assert r.decoded == tokenizer.decode(want[r.doc_id], skip_special_tokens=False)
    edits = documents(texts).withColumn("edits", F.when(F.col("doc_id") % 7 > 0, queries.sample_edits(F.col("text"))))
    for r in token_counts.edited_token_counts(edits, queries.vocabulary()).collect():
        assert r.n_tokens == len(want[r.doc_id])
        s = texts[r.doc_id] or ""
        if r.doc_id % 7 and texts[r.doc_id] is not None:
            n = len(s)
            for start, length, insert in ((n // 3, 12, s[:20]), (n // 2, 0, " (revised) "), (n * 4 // 5, 5, "")):
                s = s[:start] + insert + s[start + length :]
        assert r.n_tokens_edited == len(tokenizer.encode(s, add_special_tokens=False).ids) and r.n_chars_edited == len(s)
    assert bpe.bpe_encode(documents([]), queries.vocabulary()).count() == 0


def test_token_tree_follows_many_edits():
    codec = bpe.FragmentCodec(queries.vocabulary())
    tokenizer = Tokenizer.from_file(queries.vocabulary())
    rng = random.Random(8)
    text = text_of(rng, 900)
    tree = token_counts.TokenTree(codec, *token_counts.segmented(codec, text))
    for _ in range(60):
        start, length, insert = rng.randrange(len(text) + 5), rng.choice([0, 1, 40, 600]), text_of(rng, rng.choice([1, 3, 200]))
        tree.replace(start, length, insert)
        start = min(start, len(text))
        text = text[:start] + insert + text[start + length :]
        assert tree.text() == text and tree.count == len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_line_spread(documents):
    banner = "subscribe to our letter"
    texts = [f"line number {i} of its own\n{banner}\nsome more text here {i} and the rest of it" for i in range(12)]
    texts += [banner, None, "", banner + "\n" + banner, "short\nshort"]
    docs = documents(texts, [f"s{i % 10}" for i in range(len(texts))]).withColumn("_rid", F.lit(1))
    rows = {r.doc_id: r for r in line_spread.drop_spread_lines(docs).collect()}
    assert all(banner not in rows[i].text and rows[i].n_removed == 1 for i in range(12))
    assert rows[12].text == "" and rows[13].text is None and rows[14].text == "" and rows[15].n_removed == 2
    assert rows[16].text == "short\nshort" and (rows[14].n_lines, rows[14].n_removed, rows[13].n_lines) == (1, 0, 0)
    few = line_spread.drop_spread_lines(docs, min_sites=11).collect()
    assert {r.n_removed for r in few} == {0}
    assert line_spread.drop_spread_lines(documents([])).count() == 0


def test_line_spread_cleans_boilerplate_pages(documents):
    """Only a text that itself stands on many sites is left whole, and only where that is asked for; short lines go, too."""
    banner, rights = "subscribe to our letter, it is free", "top"
    texts = [f"{banner}\n{rights}\nown {i} text" for i in range(12)]
    texts += [f"{banner}\n{rights}"] * 3 + ["one story that is told\nand told again everywhere"] * 11
    texts += [None, "", f"and told again everywhere\n{banner}"]
    docs = documents(texts, [f"s{i % 12}" for i in range(len(texts))])
    rows = {r.doc_id: r for r in line_spread.drop_spread_lines(docs, keep_copies=True).collect()}
    assert len(rows) == len(texts)
    assert all(rows[i].text == f"own {i} text" and rows[i].n_removed == 2 for i in range(12))
    assert all(rows[i].text == "" and rows[i].n_removed == 2 for i in range(12, 15))
    assert all(rows[i].text == texts[i] and rows[i].n_removed == 0 for i in range(15, 28))
    assert rows[28].text == "" and rows[28].n_removed == 2
    bare = {r.doc_id: r.text for r in line_spread.drop_spread_lines(docs).collect()}
    assert all(bare[i] == "" for i in range(15, 26)) and bare[0] == "own 0 text"
    # The stage of the pipeline works by this rule.
    staged = corpus_pipeline.lines(None, docs, "").collect()
    assert {r.doc_id: (r.text, r.n_chars) for r in staged} == {k: (r.text, len(r.text or "")) for k, r in rows.items()}


def test_mixing_budgets(spark):
    leaves = [("a", "x", 100, 1, 1), ("a", "y", 10, 1, 3), ("b", "z", 1000, 1, 1)]
    frame = spark.createDataFrame(leaves, "g string, s string, tokens long, w_g long, w_s long")
    plan = {(r.g, r.s): r._budget for r in mixing.leaf_budgets(frame, ["g", "s"], 400, 1).collect()}
    # The shortage of y goes to its sibling x, then that of group a to group b.
    assert plan == {("a", "x"): 100, ("a", "y"): 10, ("b", "z"): 290}
    plan = {(r.g, r.s): r._budget for r in mixing.leaf_budgets(frame, ["g", "s"], 101, 1).collect()}
    assert plan[("a", "y")] == 10 and sum(plan.values()) == 101


def test_mixing_edges(documents):
    assert queries.mixed(documents([])).count() == 0
    rows = queries.mixed(documents([*ODD, (3, "one"), (None, "two three")])).collect()
    assert len(rows) == len(ODD) + 2 and all(0 <= r.copies <= 2 for r in rows)
    with pytest.raises(ValueError):
        queries.mixed(documents(["a"]).withColumn("copies", F.lit(1)))
