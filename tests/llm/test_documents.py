"""Operators on documents against plain versions, on the small table and on odd rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from brute import byte_rows, held, near_rows, quality_counts, rows_of, substring_rows
from llm_paths import SF001
from pyspark.sql import functions as F

from tidings.llm import best_fit_packing, common, minhash_forest, quality_rules, substring_dedup, suffix_dedup, suffix_tree_lm, toxicity_fm


def got(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_substring_dedup(spark, odd_docs, no_docs):
    docs = common.read(spark, SF001, "documents")
    assert got(substring_dedup.query(spark, SF001), "doc_id", "n_words", "n_removed", "kept_sha256") == substring_rows(rows_of(docs))
    found = substring_dedup.remove_repeats(odd_docs)
    sha = F.sha2(F.encode("text", "UTF-8"), 256)
    assert sorted((tuple(r) for r in found.select("row.doc_id", "n_words", "n_removed", sha).collect()), key=repr) == substring_rows(rows_of(odd_docs))
    assert set(found.select("row.*").columns) == set(odd_docs.columns)
    assert substring_dedup.remove_repeats(no_docs).count() == 0


def test_suffix_dedup(spark, odd_docs, no_docs, monkeypatch):
    docs = common.read(spark, SF001, "documents")
    cols = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    want = byte_rows(rows_of(docs))
    assert got(suffix_dedup.query(spark, SF001), *cols) == want
    found = suffix_dedup.remove_repeats(odd_docs).select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    assert got(found, *cols) == byte_rows(rows_of(odd_docs))
    assert suffix_dedup.remove_repeats(no_docs).count() == 0
    monkeypatch.setattr(suffix_dedup, "MATRIX_RUNS", 1)
    assert got(suffix_dedup.query(spark, SF001), *cols) == want
    monkeypatch.setattr(suffix_dedup, "MAX_RUNS", 1)  # every mixed anchor counted by windows
    assert got(suffix_dedup.query(spark, SF001), *cols) == want


def test_suffix_sort_against_sorted():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 99, rng.integers(1, 60)).astype(np.uint8)) for _ in range(300)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    n = np.array([len(t) for t in texts])
    start = np.cumsum(n) - n
    s = suffix_dedup.Suffixes(data, start, start + n, suffix_dedup.byte_table()[data], suffix_dedup.Powers())
    order = s.sort(np.array([0]), np.array([len(texts)]))
    assert order.tolist() == sorted(range(len(texts)), key=lambda i: (texts[i], i))
    lcp, lied = s.neighbours(order)
    assert not lied.any()
    for a, b, k in zip(order, order[1:], lcp):
        x, y = texts[a], texts[b]
        assert x[:k] == y[:k] and (k == min(len(x), len(y)) or x[k] != y[k])


def test_nodes_agree_with_all_pairs(monkeypatch):
    """Extensions of many runs of an anchor, node by node and pair by pair."""
    rng = np.random.default_rng(11)
    for trial in range(30):
        left = [bytes(rng.integers(97, 99, 12).astype(np.uint8)) for _ in range(6)]
        right = [bytes(rng.integers(97, 99, 14).astype(np.uint8)) for _ in range(6)]
        runs = sorted({left[rng.integers(6)][rng.integers(0, 9):] + b"|" + right[rng.integers(6)][:rng.integers(3, 15)] for _ in range(60)})
        off = np.array([r.index(b"|") for r in runs])
        args = (runs, off, np.ones(len(runs), np.int64), np.array([0]), np.array([len(runs)]), 14, suffix_dedup.byte_table())
        pairs = suffix_dedup.reaches(*args, suffix_dedup.Powers())
        monkeypatch.setattr(suffix_dedup, "MATRIX_RUNS", 1)
        nodes = suffix_dedup.reaches(*args, suffix_dedup.Powers())
        monkeypatch.undo()
        assert [x.tolist() for x in pairs] == [x.tolist() for x in nodes]


def test_plain_comparison_where_a_hash_lies():
    """With all bytes hashed alike everything seems equal; verification finds it and results stay right."""
    strings = [b"aaaaXYZWbbbb", b"caaaXYZWbbbb", b"cdddXYZWeeee"]
    off, copies, first, size = np.array([4, 4, 4]), np.ones(3, np.int64), np.array([0]), np.array([3])
    good = suffix_dedup.reaches(strings, off, copies, first, size, 10, suffix_dedup.byte_table(), suffix_dedup.Powers())
    bad = suffix_dedup.reaches(strings, off, copies, first, size, 10, np.ones(256, np.uint64), suffix_dedup.Powers())
    assert [x.tolist() for x in good] == [x.tolist() for x in bad] == [[3, 3, -1], [8, 8, -1]]


def test_minhash_forest(spark, odd_docs, no_docs):
    docs = common.read(spark, SF001, "documents")
    cols = ["doc_id", "n_shingles", "component_id", "kept"]
    assert got(minhash_forest.query(spark, SF001), *cols) == near_rows(rows_of(docs))
    assert got(minhash_forest.near_duplicates(odd_docs), *cols) == near_rows(rows_of(odd_docs))
    assert minhash_forest.near_duplicates(no_docs).count() == 0
    kept = minhash_forest.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns and kept.where("doc_id = 1").count() == 1 and kept.where("doc_id = 2").count() == 0


def test_minhash_links_large_group(spark):
    """A group of many near copies is one component, and a text just under the threshold stays apart."""
    rng = np.random.default_rng(5)
    base = [f"t{i}" for i in range(300)]
    rows = []
    for i in range(400):
        w = list(base)
        at = int(rng.integers(0, 290))
        w[at:at + 3] = [f"c{i}a", f"c{i}b", f"c{i}c"]
        rows.append((i, " ".join(w)))
    rows.append((1000, " ".join(base[:240] + [f"z{i}" for i in range(60)])))
    found = {r["doc_id"]: r["component_id"] for r in minhash_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {found[i] for i in range(400)} == {0} and found[1000] == 1000


def test_minhash_links_copies_that_resemble_only_the_original(spark):
    """2000 copies of one original, each unlike the other copies: the window of an order shows the original to few of them."""
    rng = np.random.default_rng(11)
    base = [f"t{i}" for i in range(604)]
    rows = [(0, " ".join(base))]
    for i in range(1, 2001):
        w = list(base)
        for k, at in enumerate(rng.choice(60, 7, replace=False) * 10 + 5):
            w[at] = f"c{i}x{k}"
        rows.append((i, " ".join(w)))
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in minhash_forest.near_duplicates(texts).collect()}
    assert set(found.values()) == {0}


def test_minhash_compares_regions_in_whole(spark, monkeypatch):
    """Pairs in a region of several blocks that lie apart in its orders."""
    monkeypatch.setattr(minhash_forest, "BLOCK_ROWS", 7)
    monkeypatch.setattr(minhash_forest, "HUBS", 1)
    monkeypatch.setattr(minhash_forest, "WINDOW", 1)
    rng = np.random.default_rng(12)
    base = [f"t{i}" for i in range(604)]
    rows = []
    for i in range(0, 200, 2):
        w = list(base)
        for k, at in enumerate(rng.choice(60, 12, replace=False) * 10 + 5):
            w[at] = f"c{i}x{k}"
        rows.append((i, " ".join(w)))
        for k, at in enumerate(rng.choice(60, 9, replace=False) * 10 + 2):
            w[at] = f"d{i}x{k}"
        rows.append((i + 1, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cols = ["doc_id", "n_shingles", "component_id", "kept"]
    found = got(minhash_forest.near_duplicates(docs), *cols)
    assert found == near_rows(rows) and len({r[2] for r in found}) == 100


def test_minhash_deals_texts_twice_at_most(spark, monkeypatch):
    """However many rounds compare members of large regions: all texts travel once for the candidates and once for the regions."""
    rng = np.random.default_rng(13)
    base = [f"t{i}" for i in range(604)]
    rows = [(0, " ".join(base))]
    for i in range(1, 301):
        w = list(base)
        for k, at in enumerate(rng.choice(60, 7, replace=False) * 10 + 5):
            w[at] = f"c{i}x{k}"
        rows.append((i, " ".join(w)))
    dealt, rounds = [], []
    packed, confirmed = minhash_forest.packed_texts, minhash_forest.confirmed
    monkeypatch.setattr(minhash_forest, "packed_texts", lambda *a: dealt.append(1) or packed(*a))
    monkeypatch.setattr(minhash_forest, "confirmed", lambda *a: rounds.append(1) or confirmed(*a))
    monkeypatch.setattr(minhash_forest, "WINDOW", 1)
    monkeypatch.setattr(minhash_forest, "HUBS", 1)
    found = minhash_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in found} == {0}
    assert len(dealt) <= 2 < len(rounds)


def test_lower_words_are_the_words():
    cases = [*map(chr, range(0x250)), "\u0130", "\u2003", "\u3000", "\ufeff", "\U0001F600"]
    text = "".join(f"A{c}b{c}{c} Z" for c in cases)
    assert [w.decode() for w in common.lower_words(text)] == common.WORD.findall(text.translate(common.LOWER))
    assert common.lower_words("") == common.lower_words(" \n\t ") == []


@pytest.mark.parametrize("percent", [85, 80])
def test_minhash_estimate_loses_less_than_the_orders(percent):
    """At the threshold the estimate's tail is below the probability of no common prefix in any order."""
    same = percent / 100
    p, n = (1 + 3 * same) / 4, minhash_forest.HASHES
    tail = sum(math.comb(n, k) * p ** k * (1 - p) ** (n - k) for k in range(math.ceil(minhash_forest._floor(percent))))
    assert tail < (1 - same ** minhash_forest.MIN_DEPTH) ** minhash_forest.TREES


def test_quality_counts_and_rules(spark, odd_docs, no_docs):
    docs = common.read(spark, SF001, "documents")
    want = {i: quality_counts(t) for i, t in rows_of(docs)}
    for r in quality_rules.query(spark, SF001).collect():
        assert tuple(r)[1:6] == want[r["doc_id"]]
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    odd = quality_rules.judge(odd_docs)
    assert odd.count() == odd_docs.count() and odd.where("kept is null").count() == 0
    assert quality_rules.keep_good(odd_docs).columns == odd_docs.columns
    assert quality_rules.judge(no_docs).count() == 0


def test_quality_rejects_outliers(spark):
    """Rows of another shape are rejected in a contaminated group, the others stay."""
    rng = np.random.default_rng(1)
    words = [f"word{i}" for i in range(2000)]
    rows = [(i, " ".join(rng.choice(words, 200)), "en", "s") for i in range(400)]
    rows += [(1000 + i, " | ".join(rng.choice(words, 150)), "en", "s") for i in range(60)]
    judged = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    kept = {r[0]: r[1] for r in judged.select("row.doc_id", "kept").collect()}
    assert all(kept[i] for i in range(400)) and not any(kept[1000 + i] for i in range(60))


def test_toxicity(spark, odd_docs, no_docs):
    d = "/root/testdata/sf0.01"
    found = toxicity_fm.query(spark, d).join(common.read(spark, d, "labels"), "doc_id").collect()
    assert all(r["held_out"] == held(r["doc_id"], 5) for r in found)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    clean = [r for r in found if not r["toxic"]]
    toxic = [r for r in found if r["toxic"]]
    assert sum(r["predicted"] for r in clean) <= 0.02 * len(clean)
    assert sum(r["predicted"] for r in toxic) >= 0.5 * len(toxic)
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    assert toxicity_fm.drop_toxic(odd_docs, labels).columns == odd_docs.columns
    assert toxicity_fm.drop_toxic(odd_docs, labels.limit(0)).count() == odd_docs.count()
    assert toxicity_fm.drop_toxic(no_docs, labels).count() == 0


def test_factorization_machine_learns_pairs():
    """Two terms that mean something only together: no additive model separates these."""
    index = {0: 0, 1: 1}
    rows = [np.array(x, np.int64) for x in ([0], [1], [0, 1], [])] * 200
    label = np.array([0.0, 0.0, 1.0, 0.0] * 200)
    m = toxicity_fm.fit(rows, label, index)
    p = [1 / (1 + np.exp(-m.raw(r))) for r in rows[:4]]
    assert p[2] > 0.9 and max(p[0], p[1], p[3]) < 0.1


def test_packing(spark, odd_docs, no_docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(best_fit_packing.TOKENIZER))
    for docs, d in ((common.read(spark, SF001, "documents"), SF001), (odd_docs, None)):
        found = (best_fit_packing.query(spark, d) if d else best_fit_packing.pack_documents(docs)).toPandas()
        want = []
        for i, text in rows_of(docs):
            ids = t.encode(text, add_special_tokens=False).ids + [0]
            for n, s in enumerate(range(0, len(ids), 2048)):
                x = np.array(ids[s:s + 2048], "<u4")
                want.append((None if i is None else int(i), n, s, len(x), zlib.crc32(x.tobytes())))
        have = [(None if np.isnan(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in found.itertuples()]
        assert sorted(have, key=repr) == sorted(want, key=repr)
        for _, g in found.groupby("sequence_id"):
            g = g.sort_values("offset")
            assert (g.offset.to_numpy() == np.r_[0, g.length.cumsum().to_numpy()[:-1]]).all() and g.length.sum() <= 2048
    assert best_fit_packing.pack_documents(no_docs).count() == 0


@pytest.mark.parametrize("mean", [3.0, 5.0, 6.5])
def test_pattern_plan(mean):
    rng = np.random.default_rng(int(10 * mean))
    length = np.clip(rng.lognormal(mean, 1, 5000).astype(int), 1, 2048)
    counts = np.bincount(length, minlength=2049)
    plan = best_fit_packing.pack_counts(counts)
    used = np.zeros(2049, int)
    for uses, pattern in plan:
        assert sum(pattern) <= 2048
        np.add.at(used, pattern, uses)
    assert (used == counts).all()
    assert sum(u for u, _ in plan) <= 1.01 * -(-length.sum() // 2048) + 1


def test_language_model(spark, odd_docs, no_docs):
    from brute import LOWER, WORD

    for docs, found in ((common.read(spark, SF001, "documents"), suffix_tree_lm.query(spark, SF001).collect()),
                        (odd_docs, suffix_tree_lm.score(odd_docs).withColumn("held_out", ~F.col("train")).collect())):
        rows = [(i, WORD.findall(t.translate(LOWER)) + ["\n"]) for i, t in rows_of(docs)]
        c = Counter(w for i, ws in rows if not held(i, 10) for w in ws)
        n, z = sum(c.values()), sum(c.values()) + 0.1 * (len(c) + 1)
        want = sorted(((i, held(i, 10), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.1) / z) for w in ws), 5))
                       for i, ws in rows), key=repr)
        have = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in found),
                      key=repr)
        assert [w[:5] for w in want] == [h[:5] for h in have]
        assert all(abs(w[5] - h[5]) < 1e-3 for w, h in zip(want, have))
        assert all(r["score"] <= 1e-9 and math.isfinite(r["score"]) for r in found)
    assert suffix_tree_lm.score(no_docs).count() == 0


def _suffix_tree(rows, order, min_count, min_bits, discount):
    """Plain suffix tree of training rows in one block: (word counts, states: context -> (shares, rest))."""
    words = Counter(w for ws in rows for w in ws)
    n, grams = sum(words.values()), {}
    for k in range(2, order + 1):
        grams[k] = Counter()
        for ws in rows:
            u = ["<start>", *ws]
            grams[k].update(tuple(u[i:i + k]) for i in range(len(u) - k + 1))
        grams[k] = {g: c for g, c in grams[k].items() if c >= min_count and (k == 2 or g[:-1] in grams[k - 1] and g[1:] in grams[k - 1])}
    states, p = {}, {1: {w: (c - discount) / n for w, c in words.items()}}
    for k in range(2, order + 1):
        by = {}
        for g, c in grams[k].items():
            by.setdefault(g[:-1], {})[g[-1]] = c
        p[k] = {}
        for context, after in by.items():
            if k == 2:
                total = len(rows) if context == ("<start>",) else words[context[0]]
                parent = {w: p[1][w] for w in after}
            else:
                total, parent = grams[k - 1][context], {w: p[k - 1][*context[1:], w] for w in after}
            share = {w: (c - discount) / total for w, c in after.items()}
            rest = 1 - sum(share.values())
            q = {w: share[w] + rest * parent[w] for w in after}
            state = sum(c * math.log2(q[w] / parent[w]) for w, c in after.items()) >= min_bits
            if state:
                states[context] = share, rest
            p[k] |= {(*context, w): (q if state else parent)[w] for w in after}
    return words, states


def _tree_score(ws, words, states, order, discount):
    n, v, total = sum(words.values()), len(words), 0.0
    u = ["<start>", *ws]
    for i in range(1, len(u)):
        p = (words[u[i]] - discount) / n if words[u[i]] else v * discount / n
        for k in range(1, order):
            if i - k >= 0 and (s := states.get(tuple(u[i - k:i]))):
                p = s[0].get(u[i], 0.0) + s[1] * p
        total += math.log10(p)
    return total


def test_language_model_score_against_brute_force(spark, odd_docs):
    """All texts are one block, so candidates are simply the frequent grams."""
    docs = common.read(spark, SF001, "documents").select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text")).coalesce(1)
    rows = [(i, suffix_tree_lm.tokens(t)) for i, t in rows_of(docs)]
    lm = suffix_tree_lm
    words, states = _suffix_tree([ws for i, ws in rows if not held(i, 10)], lm.ORDER, lm.MIN_COUNT, lm.MIN_BITS, lm.DISCOUNT)
    assert {len(c) for c in states} == {1, 2, 3}
    want = sorted((repr(i), len(ws), _tree_score(ws, words, states, lm.ORDER, lm.DISCOUNT)) for i, ws in rows)
    have = sorted((repr(r["doc_id"]), r["n_tokens"], r["score"]) for r in lm.score(docs).collect())
    assert [w[:2] for w in want] == [h[:2] for h in have]
    assert all(abs(w[2] - h[2]) < 1e-6 * (1 + abs(w[2])) for w, h in zip(want, have))


def test_language_model_counts_across_blocks(spark):
    """Grams that no block holds three times are candidates too: texts one a task and all in one give the same scores."""
    docs = spark.createDataFrame([(i, f"one two three four five w{i % 3}") for i in range(12)] + [(99, None)], "doc_id long, text string")
    one, many = ({r["doc_id"]: r["score"] for r in suffix_tree_lm.score(d).collect()} for d in (docs.coalesce(1), docs.repartition(13, "doc_id")))
    assert one.keys() == many.keys() and all(abs(one[i] - many[i]) < 1e-9 * (1 + abs(one[i])) for i in one)
    assert suffix_tree_lm.Model(common.Table(suffix_tree_lm.blocks(common.keyed(docs.repartition(13, "doc_id")).withColumn("train", F.lit(True))), "blocks").df()).grams_kept[0]


def test_language_model_of_many_blocks(spark, monkeypatch):
    """Blocks of a few texts: what is learned grows with the corpus, scores stay proper."""
    monkeypatch.setattr(suffix_tree_lm, "BLOCK_TOKENS", 2000)
    docs = common.read(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    kept = []
    for part in (docs.where("doc_id < 200"), docs):
        rows = common.Table(suffix_tree_lm.blocks(common.keyed(part).withColumn("train", F.lit(True))), "blocks").df()
        model = suffix_tree_lm.Model(rows)
        kept.append(model.grams_kept)
    assert all(b > 1.5 * a > 0 for a, b in zip(*kept))
    found = suffix_tree_lm.score(docs).collect()
    assert len(found) == docs.count() and all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)
    held_out = [r for r in found if not r["train"]]
    assert sum(r["score"] for r in held_out) > sum(r["base_score"] for r in held_out)


def test_language_model_candidates_stand_at_one_block(spark):
    """Every frequent gram comes once with its whole count, named by one block that has it, whatever the number of blocks that do."""
    lm = suffix_tree_lm
    docs = spark.createDataFrame([(i, f"one two three four five w{i % 3}") for i in range(12)], "doc_id long, text string").repartition(13, "doc_id")
    rows = common.Table(lm.blocks(common.keyed(docs).withColumn("train", F.lit(True))), "blocks").df()
    everything = lm.Filter(lm.FILTER_BITS[0], np.full(1 << (lm.FILTER_BITS[0] - 6), ~np.uint64(0)))
    for order in range(2, lm.ORDER + 1):
        want = Counter()
        for _, t in rows_of(docs):
            u = ["<start>", *lm.tokens(t)]
            want.update(tuple(u[i:i + order]) for i in range(len(u) - order + 1))
        found = common.Table(lm.candidates(rows, order, everything, 84, lm.MIN_COUNT), "found").df()
        grams = lm.named(rows, found, order).collect()
        assert sorted(r["c"] for r in grams) == sorted(c for c in want.values() if c >= lm.MIN_COUNT)
        assert len({r["gram"] for r in grams}) == len({(r["context"], r["token"]) for r in grams}) == len(grams) == found.agg(F.sum("n")).first()[0]


def test_language_model_words_are_split_as_tokens():
    """Whole columns of text are split into the same words as text by text."""
    rng = np.random.default_rng(4)
    chars = [*map(chr, range(40)), *"ABZabz\u00c0\u00df\u03a3\u0085\u00a0\u3000\U0001f600", *" " * 12]
    texts = ["", " ", "a", " a  B "] + ["".join(rng.choice(chars, rng.integers(60))) for _ in range(500)]
    words, size = suffix_tree_lm.split_words(pa.array(["x"] + texts).slice(1))
    want = [suffix_tree_lm.tokens(t)[:-1] for t in texts]
    assert words.to_pylist() == [w for ws in want for w in ws] and size.tolist() == [len(ws) for ws in want]
    assert suffix_tree_lm.word_hashes(words.slice(5, 9)).tolist() == [xxhash.xxh3_64_intdigest(w) for w in words.slice(5, 9).to_pylist()]


def test_language_model_is_dealt_in_cells(spark):
    """The model is packed once, a row a cell, and a block gets back only the keys that the model has."""
    lm = suffix_tree_lm
    docs = spark.createDataFrame([(i, f"one two three four five w{i}") for i in range(12)], "doc_id long, text string")
    rows = common.Table(lm.blocks(common.keyed(docs).withColumn("train", F.col("doc_id") < 11)), "blocks").df()
    model = lm.Model(rows)
    cells = model.table.collect()
    assert len({r["cell"] for r in cells}) == len(cells) <= 2
    keys = {k for r in cells for k in np.cumsum(lm.unpacked(r["keys"], r["n"], np.uint64), dtype=np.uint64).tolist()}
    known = lm.answers_of(model.table.toArrow())
    assert len(keys) == sum(r["n"] for r in cells) and known.of(np.array(sorted(keys), np.uint64))[0].all()
    for r in model.answers(rows).collect():
        assert keys.issuperset(np.cumsum(lm.unpacked(r["keys"], r["n"], np.uint64), dtype=np.uint64).tolist())


def test_language_model_states_are_distributions(spark):
    """After any context the probabilities of all tokens and of the unseen one sum to 1."""
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(["a", "b", "c", "d"], 30, p=[0.5, 0.2, 0.2, 0.1])) + " x y z" * 3 for _ in range(60)]
    rows = [suffix_tree_lm.tokens(t) for t in texts]
    words, states = _suffix_tree(rows, suffix_tree_lm.ORDER, suffix_tree_lm.MIN_COUNT, suffix_tree_lm.MIN_BITS, suffix_tree_lm.DISCOUNT)
    assert ("x",) in states
    for context in (["a"], ["x"], ["x", "y"], ["y", "z"], ["b", "x"], ["z", "x", "y"]):
        before = _tree_score(context, words, states, suffix_tree_lm.ORDER, suffix_tree_lm.DISCOUNT)
        total = sum(10 ** (_tree_score([*context, w], words, states, suffix_tree_lm.ORDER, suffix_tree_lm.DISCOUNT) - before) for w in [*words, "unseen"])
        assert abs(total - 1) < 1e-9
