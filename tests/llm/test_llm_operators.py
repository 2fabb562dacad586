"""Operators of tarmac.llm against brute force and on edge rows."""

import base64
import collections
import hashlib
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tarmac.llm import (langid, licenses, mixing, near_dup, oracle, packing, quality_model, quality_rules, token_counts,
                        topk, warc)
from tarmac.llm.common import held_out, read, table

SF001 = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, node string"
TRICKY = ["", " ", None, "a", "  a  b ", "é ü  x", "x <|endoftext|> y", "中文 字 a", "a b  c", "\n\n a\n b",
          "all rights reserved CC BY cc-by General Public License", "it's 's don't 12 345 $$$ ###", "w " * 400,
          "one two three four five six seven", "one two three four five six seven", "123 !!!"]
PATHS = (P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


@pytest.fixture(scope="module")
def docs(spark):
    """Whole smallest table, edge texts, repeated rows, null ids and clashing extra columns."""
    table = read(spark, SF001, "documents").select("doc_id", "text", "lang", "source", "n_chars", F.lit(0.5).alias("score"), F.lit("x").alias("node"))
    edge = [(10_000 + i, t, None if i % 2 else "en", None if i % 3 else "src0", 0, None, None) for i, t in enumerate(TRICKY)]
    edge += [(None, "no id here", None, None, None, None, None)] * 2 + [(10_013, TRICKY[13], "en", "src0", 0, None, None)]
    edge += [(20_000, "word " * 300_000, "en", "src0", 0, None, None)]
    return table.unionByName(spark.createDataFrame(edge, SCHEMA)).coalesce(4).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return docs.collect()


def test_language_id(spark, docs):
    model = langid.train(docs)
    got = langid.predict(docs, model, held_out(F.col("doc_id")).alias("held_out")).collect()
    assert len(got) == docs.count()
    truth = {r.doc_id: r.lang for r in read(spark, SF001, "documents").collect()}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert held and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    text = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    for r in got:
        if r.doc_id is not None:
            lettered = any(c.isalpha() for c in text[r.doc_id] or "")
            assert (r.lang_pred == "und") == (not lettered)
    kept = langid.keep_accepted(docs, model)
    assert kept.columns == docs.columns
    assert kept.filter(F.col("doc_id") < 10_000).count() >= 0.99 * len(truth)
    assert langid.predict(docs.limit(0), model).count() == 0
    unlabelled = langid.train(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in langid.predict(docs, unlabelled).collect()} == {"und"}


def test_language_threshold_is_a_quantile_over_all_labelled_rows(spark, monkeypatch):
    # as if one odd text of the calibration slice had set the threshold
    monkeypatch.setattr(langid, "_calibrate", lambda *_: (0.1, 0.05))
    words = {"en": "the house and water of this".split(), "xx": "zorg blik vrun plakt druv".split()}
    rng = np.random.RandomState(2)
    rows = [(i, " ".join(rng.choice(words[lang], 20)), lang) for i in range(8000) for lang in [("en", "xx")[i % 2]]]
    rows = [(i, " ".join(words["en"][:5] + words["xx"]) if i % 2000 == 7 else t, lang) for i, t, lang in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, sample_docs=1000)
    assert model.threshold > 0.05
    labelled = langid._labelled(docs, 1000, 11).filter("NOT drawn").select("doc_id", "lang").collect()
    truth = {r.doc_id: r.lang for r in labelled}
    right = sorted(r.score for r in langid.predict(docs, model).collect() if truth.get(r.doc_id) == r.lang_pred)
    want = right[int(langid.REJECT_SHARE * len(right))]
    assert len(right) > 4000
    assert want - 1 / langid.STEPS <= model.threshold <= want or (want > 0.5 and model.threshold == 0.5)


def test_quality_classifier(spark, docs):
    labels = read(spark, SF001, "labels")
    model = quality_model.train(docs, labels)
    got = quality_model.predict(docs, model, held_out(F.col("doc_id")).alias("held_out"))
    scored = got.join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in scored]) > 0.9
    assert np.mean([r.predicted for r in scored if r.quality == 1]) > 0.95
    assert got.count() == docs.count() and got.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert quality_model.keep_good(docs, model).columns == docs.columns
    none = quality_model.train(docs, labels.limit(0))
    assert {r.score for r in quality_model.predict(docs, none).collect()} == {0.5}


def test_token_counts_against_plain_recurrence(docs, rows):
    pieces = token_counts.UnigramPieces(PATHS[1])
    split = re.compile(rb"(?: ?[^ \t\n\x0b\x0c\r]+)|(?:[ \t\n\x0b\x0c\r]+(?= [^ \t\n\x0b\x0c\r]))|[ \t\n\x0b\x0c\r]+")
    memo = {}

    def count(text):
        words = split.findall((text or "").encode())
        return len(words), sum(memo.setdefault(w, None) or memo.__setitem__(w, pieces.run_count(w)) or memo[w] for w in words)

    got = collections.Counter((r.doc_id, r.n_pretokens, r.n_tokens) for r in token_counts.token_counts(docs, PATHS[1]).collect())
    assert got == collections.Counter((r.doc_id, *count(r.text)) for r in rows)


def test_token_counts_use_every_piece_of_the_vocabulary(spark):
    with open(PATHS[1], "rb") as lines:
        ranks = {base64.b64decode(p): int(r) for p, r in map(bytes.split, lines)}
    longest = max(map(len, ranks))
    total = np.log(sum(1 / (r + token_counts.ZIPF_SHIFT) for r in ranks.values()))
    logp = {p: -np.log(r + token_counts.ZIPF_SHIFT) - total for p, r in ranks.items()}

    def count(word):
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            found = [(best[start][0] + logp[word[start:end]], -best[start][1] - 1)
                     for start in range(max(0, end - longest), end) if word[start:end] in logp]
            score, tokens = max(found)
            best.append((score, -tokens))
        return best[-1][1]

    rng = np.random.RandomState(5)
    chars = [chr(c) for c in range(0x4E00, 0x4E00 + 3000)] + list("\u3002\uff0c\u306e\u308b\u30fc")
    unspaced = ["".join(rng.choice(chars, n)) for n in (17, 60, 400, 3000)]
    unspaced += [base64.b64encode(rng.bytes(n)).decode() for n in (40, 500, 4000)]
    unspaced += ["https://example.org/" + "/".join("item-%d?view=%s&page=%d" % (i, "full" * (i % 3), i * i) for i in range(n)) for n in (2, 30)]
    unspaced += ["thequickbrownfoxjumpsoverthelazydog" * n for n in (2, 50)] + ["a" * 5000, "ab" * 1000 + "\u00e9" * 700]
    words = unspaced + [c * n for c in "-._=*\u2014" for n in (16, 32, 33, 47, 48, 64, 65, 128, 200)]
    words += [p.decode() for p in ranks if len(p) > 32 and not re.search(rb"[\x00-\x20\x80-\xff]", p)]
    got = token_counts.token_counts(spark.createDataFrame(list(enumerate(words)), "doc_id long, text string"), PATHS[1]).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: count(w.encode()) for i, w in enumerate(words)}
    assert {r.doc_id: r.n_tokens for r in got}[words.index("-" * 64)] == 1
    # sentences without spaces go through the trie: no part of them is over LONG bytes
    pieces = token_counts.UnigramPieces(PATHS[1])
    raw = unspaced[3].encode()
    assert np.diff(pieces.borders(raw, np.array([0])), append=len(raw)).max() <= token_counts.LONG


def test_borders_do_not_depend_on_the_bytes_at_once(monkeypatch):
    pieces = token_counts.UnigramPieces(PATHS[1])
    raw = np.random.RandomState(9).bytes(3000) + b"the quick brown fox" * 50
    whole = pieces.borders(raw, np.array([0, 100]))
    for size in (1, 2, 3, 7, 64):
        monkeypatch.setattr(token_counts, "BYTES_AT_ONCE", size)
        assert (pieces.borders(raw, np.array([0, 100])) == whole).all()


def test_packing_covers_every_id_once(spark, docs, rows):
    got = packing.pack(spark, docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), *PATHS).toPandas()
    tokenizer = Tokenizer.from_file(PATHS[0])
    texts = {r.doc_id: r.text or "" for r in rows if r.doc_id is not None}
    for doc_id, part in got.sort_values("start").groupby("doc_id"):
        ids = np.array(tokenizer.encode(texts[doc_id], add_special_tokens=False).ids + [0], "<u4")
        assert list(part.start) == [0, *np.cumsum(part.length)[:-1]] and part.length.sum() == len(ids) == part.doc_tokens.iloc[0]
        for p in part.itertuples():
            assert zlib.crc32(ids[p.start:p.start + p.length].tobytes()) == p.ids_crc32
    assert set(got.doc_id) == set(texts)
    padding = 0
    for _, part in got.sort_values("offset").groupby("sequence_id"):
        assert list(part.offset) == [0, *np.cumsum(part.length)[:-1]]
        full = int(part.length.sum())
        assert full <= 1024
        padding += 0 if full & (full - 1) == 0 else 1024 - full
    assert padding < 1024
    assert packing.pack(spark, docs.limit(0), *PATHS).count() == 0


def test_plan_fills_all_windows_but_one():
    rng = np.random.RandomState(3)
    for histogram in ({}, {7: 1}, {700: 1000}, {1: 3000}, {700: 1000, 300: 10}, {int(k): int(n) for k, n in zip(rng.randint(1, 1024, 300), rng.randint(1, 99, 300))}):
        full = collections.Counter()
        used = collections.Counter()
        for size, lo, hi, cut, piece, first, _ in packing.plan_windows(histogram):
            for r in range(lo, hi):
                used[(size, r)] += piece
                full[first + r - lo] += piece
        assert used == {(s, r): s for s, n in histogram.items() for r in range(n)}
        assert all(x <= 1024 for x in full.values()) and sum(x < 1024 for x in full.values()) <= 1


def test_places_are_found_whatever_the_counts():
    histogram = {size: int(1e7 / size**0.5) for size in range(1, 1024)}
    rows = packing.plan_windows(histogram)
    places = packing.Places(rows)
    assert len(places.starts) <= 2 * len(rows) and places.n.max() <= 3 and len(places.listed) < 4 * len(rows)
    rng = np.random.RandomState(3)
    size = rng.randint(1, 1024, 300)
    rank = np.array([rng.randint(0, histogram[s]) for s in size])
    edge = places.rows[rng.choice(len(rows), 100)]  # first ranks of plan rows
    size, rank = np.append(size, edge[:, 0]), np.append(rank, edge[:, 1])
    asked, at = places.find(size, rank)
    want = [(i, j) for i in range(len(size)) for j in np.flatnonzero(
        (places.rows[:, 0] == size[i]) & (places.rows[:, 1] <= rank[i]) & (rank[i] < places.rows[:, 2]))]
    assert sorted(zip(asked, at)) == want
    for i in range(len(size)):
        held = places.rows[at[asked == i]]
        assert held[:, 4].sum() == size[i]  # the parts are the whole remainder


def test_warc_round_trip(spark):
    pages = read(spark, SF001, "pages")
    extra = spark.createDataFrame([(9001, "u\n x", None), (9002, None, ""), (None, "n", "zzz"), (9003, "q", "a\nb\r\n\r\nc")], "page_id long, url string, html string")
    pages = pages.unionByName(extra).unionByName(pages.limit(9).withColumn("page_id", F.col("page_id") + 5000)).withColumn("sha1", F.lit("x"))
    got = {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archive_round_trip(spark, pages).collect()}
    first = {}
    for r in pages.collect():
        body = (r.html or "").encode()
        if r.page_id is not None:
            first[body] = min(first.get(body, r.page_id), r.page_id)
    want = set()
    for r in pages.collect():
        body = (r.html or "").encode()
        again = first.get(body) not in (None, r.page_id)
        want.add((r.page_id, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response",
                  first[body] if again else None))
    assert got == want
    assert warc.archive_round_trip(spark, pages.limit(0)).count() == 0


def test_every_archive_file_holds_its_dictionary(spark, tmp_path):
    pages = read(spark, SF001, "pages").coalesce(1)
    path = str(tmp_path / "archives")
    warc.write_archives(pages, path, file_rows=7)
    files = [f.read_bytes() for f in (tmp_path / "archives").glob("part-*")]
    assert all(raw.startswith(warc.struct.pack("<I", warc.DICTIONARY_MAGIC)) for raw in files)
    counts = [sum(1 for _ in warc.frames_of(raw)) for raw in files]
    assert max(counts) == 6 and sum(counts) == pages.count()
    got = {(r.page_id, r.payload_bytes) for r in warc.read_archives(spark, path).collect()}
    assert got == {(r.page_id, len((r.html or "").encode())) for r in pages.collect()}


@pytest.mark.parametrize("rows_per_block", [40, 1 << 15])
def test_top_k_against_brute_force(spark, rows_per_block):
    table = read(spark, SF001, "embeddings").select("vec_id", "embedding")
    odd = spark.createDataFrame([(2000, None), (2050, [1.0, None]), (2100, [float("nan")] * 64), (None, [0.1] * 64), (2150, []), (2200, [3.0] * 64)],
                                "vec_id long, embedding array<float>")
    vectors = table.unionByName(table.limit(30).withColumn("vec_id", F.col("vec_id") + 1000)).unionByName(table.limit(2)).unionByName(odd)
    kept = [(r.vec_id, np.floor(256 * np.array(r.embedding, float)).astype(int)) for r in vectors.collect()
            if r.vec_id is not None and r.embedding and None not in r.embedding and np.isfinite(r.embedding).all()]
    want = []
    for a, (i, q) in enumerate(kept):
        if i % 50 == 0:
            best = sorted((-int(q @ v), j) for b, (j, v) in enumerate(kept) if b != a)[:5]
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    got = topk.top_k(spark, vectors, F.col("vec_id") % 50 == 0, rows_per_block=rows_per_block).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)
    assert topk.top_k(spark, vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_of_large_components_against_sql(spark):
    rng = np.random.RandomState(5)
    rows = [(i, [float(x) for x in rng.uniform(-1, 1, 8)]) for i in range(120)]
    for i, big in ((0, 2.0**23), (7, -2.0**23), (50, 2.0**40), (61, -2.0**44), (99, 2.0**33)):
        rows[i][1][i % 8] = big
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(spark, vectors, F.col("vec_id") % 50 == 0, rows_per_block=40)
    assert {r.query_id for r in got.collect()} == {0, 50, 100}
    _against_sql(vectors, oracle.TOPK, got, "embeddings")
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(spark, spark.createDataFrame([(0, [1e30]), (1, [1.0])], "vec_id long, embedding array<double>"), F.lit(True)).collect()


def test_near_duplicates_against_all_pairs(spark, docs, rows):
    base = " ".join(f"w{i}" for i in range(200)).split()
    near = [(30_000 + k, " ".join(base[:k * 3] + [f"new{k}"] + base[k * 3 + 1:]), "en", "s", 0, None, None) for k in range(40)]
    far = [(31_000 + k, " ".join(base[:60] + [f"x{k}_{i}" for i in range(140)]), "en", "s", 0, None, None) for k in range(20)]
    every = docs.unionByName(spark.createDataFrame(near + far, SCHEMA))
    got = {(r.doc_id, r.digest): r.class_id for r in near_dup.near_duplicates(spark, every).collect()}
    texts, df, n = {}, collections.Counter(), 0
    for r in every.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").lower())
        bag = collections.Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else {}
        n += 1
        df.update(bag.keys())
        if words and r.doc_id is not None:
            texts[r.doc_id] = bag
    weight = {s: 1 + near_dup.IDF_SPAN * int(near_dup.idf_levels(np.array([c]), n)[0]) / near_dup.LEVELS for s, c in df.items()}
    total = {d: sum(weight[s] * c for s, c in bag.items()) for d, bag in texts.items()}
    holders = collections.defaultdict(list)
    for d, c in texts.items():
        for s in c:
            holders[s].append(d)
    shared = {(a, b) for ds in holders.values() for i, a in enumerate(ds) for b in ds[i + 1:]}
    parent = {d: d for d in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in shared:
        both = sum(weight[s] * c for s, c in (texts[a] & texts[b]).items())
        if both / (total[a] + total[b] - both) >= 0.8 - 1e-9 and root(a) != root(b):
            parent[max(root(a), root(b))] = min(root(a), root(b))
    classes = {d: c for (d, _), c in got.items()}
    assert {d: classes[d] for d in texts} == {d: root(d) for d in texts}
    assert len({classes[30_000 + k] for k in range(40)}) == 1 and len({classes[31_000 + k] for k in range(20)}) == 20
    kept = near_dup.keep_one(spark, every)
    assert kept.columns == every.columns
    ids = [r.doc_id for r in kept.filter(F.col("text").rlike(r"\S")).select("doc_id").collect()]
    assert sorted(map(str, ids)) == sorted(map(str, {c for (d, g), c in got.items() if g is not None}))
    assert near_dup.near_duplicates(spark, docs.limit(0)).count() == 0


def test_near_duplicates_refuse_a_similarity_below_the_bands(spark, docs):
    with pytest.raises(ValueError, match="0.8 or more"):
        near_dup.near_duplicates(spark, docs, similarity=0.6)
    with pytest.raises(ValueError, match="0.8 or more"):
        near_dup.keep_one(spark, docs, similarity=0.79)


def test_near_duplicate_levels_are_those_of_exact_document_frequencies(spark):
    # far more shingles than 2^18: 600 texts of 1,000 words, one passage in all, one in every tenth
    texts = [" ".join(["all"] * 6 + (["tenth"] * 6 if i % 10 == 0 else []) + [f"w{i}_{k}" for k in range(1000)]) for i in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    n, _, bits, place_bytes = near_dup.layout(docs)
    at = table(spark, near_dup.placed(docs, place_bytes), "placed")
    assert at.select("place").distinct().count() > 20
    rows = near_dup.sign(at, near_dup.document_levels(at, n, bits), n, bits).collect()
    of = lambda df: int(near_dup.idf_levels(np.array([df]), n)[0])
    assert n == len(rows) == 600 and of(1) > of(60) > of(600)
    for r in rows:
        words = texts[r.doc_id].split()
        want = collections.Counter({of(600): 2, of(60): 6 if r.doc_id % 10 == 0 else 0})
        want[of(1)] = len(words) - 4 - sum(want.values())
        assert collections.Counter(r.levels) == +want


def test_a_row_that_a_third_repeats_lies_in_many_places(spark):
    hot = [(7, "the same words of a row that comes again and again in one table " * 40)] * 2000
    rare = [(100 + i, " ".join(f"w{i}_{k}" for k in range(200))) for i in range(600)] + [(None, None)] * 500
    docs = spark.createDataFrame(hot + rare, "doc_id long, text string").repartition(4)
    _, _, bits, place_bytes = near_dup.layout(docs)
    dealt = table(spark, near_dup.placed(docs, place_bytes), "placed")
    assert dealt.filter("doc_id = 7").select("place").distinct().count() > 20
    asked = near_dup._asked(dealt, bits).groupBy("part").agg(F.sum(F.length("hashes") / 4).alias("n")).agg(F.max("n")).first()[0]
    assert asked < 3 * dealt.select("place").distinct().count() + 1500  # entries, of 2,000 copies
    got = near_dup.near_duplicates(spark, docs)
    assert got.count() == len(hot) + len(rare) and got.filter("class_id = 7").count() == 2000
    assert got.select("class_id").distinct().count() == 602


def _against_sql(docs, sql, got, name="documents"):
    con = duckdb.connect()
    con.register(name, docs.toArrow())
    rel = con.sql(sql)
    order = sorted(rel.columns)
    key = lambda rows, cols: sorted(repr(tuple(r[cols.index(c)] for c in order)) for r in rows)
    assert key([tuple(r) for r in got.select(order).collect()], order) == key(rel.fetchall(), rel.columns)


def test_mixing(docs):
    got = mixing.mix(docs)
    _against_sql(docs, oracle.MIXING, got.select("doc_id", "size", "source_size", "target", "taken"))
    rows = got.collect()
    seen = [r.position for r in rows if r.position is not None]
    assert seen == sorted(seen) and 0 <= seen[0] and seen[-1] <= 1
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows)
    kept = mixing.mixed_rows(docs)
    assert kept.columns == docs.columns
    assert mixing.mix(docs.limit(0)).count() == 0


def test_positions_invert_the_schedule(spark):
    knots = ((0.0, 2.0), (0.25, 1.0), (1.0, 0.5))
    df = spark.range(101).select((F.col("id") / 100).alias("u"), F.array(*(F.struct(F.lit(t).alias("t"), F.lit(r).alias("rate")) for t, r in knots)).alias("knots"))
    rows = df.withColumn("parts", mixing._parts()).select("u", mixing.position_of(F.col("u"), F.col("parts")).alias("t")).collect()
    grid = np.linspace(0, 1, 200_001)
    supplied = np.cumsum(np.interp(grid, *zip(*knots)))
    supplied /= supplied[-1]
    assert all(abs(np.interp(r.u, supplied, grid) - r.t) < 1e-3 for r in rows)


def test_quality_rules(docs):
    got = quality_rules.judge(docs)
    short = F.coalesce(F.col("doc_id"), F.lit(0)) != 20_000  # the SQL repeats a text's words for each word
    _against_sql(docs.filter(short), oracle.RULES, got.filter(short).drop("rejected_by"))
    long = got.filter("doc_id = 20000").first()
    assert (long.n_words, long.word_chars, long.n_repeat_words, long.kept) == (300_000, 1_200_000, 300_000, False)
    assert quality_rules.judge(docs.limit(0)).count() == 0


def test_cascade_orders_by_rejection_per_cost(spark):
    df = spark.range(100).withColumnRenamed("id", "doc_id")
    rules = [quality_rules.Rule("dear", F.col("doc_id") < 50, F.lit(100.0)), quality_rules.Rule("cheap", F.col("doc_id") < 20, F.lit(1.0)),
             quality_rules.Rule("never", F.lit(False), F.lit(1.0))]
    ordered = quality_rules.cascade_order(rules, quality_rules.estimates(df, rules))
    assert [r.name for r in ordered] == ["cheap", "dear", "never"]
    names = df.select(quality_rules.first_rejection(ordered).alias("n")).collect()
    assert collections.Counter(r.n for r in names) == {"cheap": 20, "dear": 30, None: 50}


def test_license_scan(spark, docs):
    extra = [(40_000, "This work is LICENSED under the big Apache License, Version 2.0!", "en", "s", 0, None, None)]
    every = docs.filter("doc_id IS NULL OR doc_id <> 20000").unionByName(spark.createDataFrame(extra, SCHEMA))
    got = licenses.scan(spark, every)
    _against_sql(every, oracle.LICENSES, got)
    assert got.filter("doc_id = 40000").first().labels == "apache-2.0"
    assert got.filter("doc_id = 10010").first().n_base == 4
    assert licenses.scan(spark, docs.limit(0)).count() == 0


# notices as they stand in files
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
later version."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#     http://www.apache.org/licenses/LICENSE-2.0
# Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
# "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
# specific language governing permissions and limitations under the License."""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
CC = """This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License. To view a copy
of this license, visit http://creativecommons.org/licenses/by-sa/4.0/ or send a letter to Creative Commons, PO Box 1866,
Mountain View, CA 94042, USA."""


def test_whole_notices_with_words_put_in_and_left_out(spark):
    want = {"gpl-notice": GPL, "apache-2.0": APACHE, "mit": MIT, "bsd": BSD, "creative-commons": CC}
    prose = "the copy of the book that was sent to the person in the city is subject to the following remarks in all copies "
    texts, labels = [], []
    for label, notice in want.items():
        words = notice.split()
        half = len(words) // 2
        put_in = words[:half] + ["four", "words", "put", "in"] + words[half:]
        left_out = words[:half] + words[half + 3:]
        scattered = [w for i, w in enumerate(words) for w in ([w, "xx"] if i % 15 == 7 else [w])]
        for form in (words, put_in, left_out, scattered):
            texts += [" ".join(form), prose * 5 + " ".join(form) + "\n" + prose * 5]
            labels += [label, label]
    texts += [prose * 100, "the software and of the license " * 200, " ".join(w for n in want.values() for w in n.split()[::2])]
    labels += ["", "", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = licenses.scan(spark, docs)
    found = {r.doc_id: set(r.labels.split(",")) - {"gpl"} for r in got.collect()}
    missed = [(i, labels[i], found[i]) for i in range(len(texts)) if found[i] - {""} != {labels[i]} - {""}]
    assert not missed
    _against_sql(docs, oracle.LICENSES, got)


def test_near_duplicates_lose_no_link_of_a_whole_table(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    classes = {r.doc_id: r.class_id for r in near_dup.near_duplicates(spark, docs).collect()}
    df, bags, rows = collections.Counter(), {}, docs.collect()
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").lower())
        if words:
            bags[r.doc_id] = collections.Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))
            df.update(bags[r.doc_id].keys())
    level = {c: int(near_dup.idf_levels(np.array([c]), len(rows))[0]) for c in set(df.values())}
    weight = {s: 1 + near_dup.IDF_SPAN * level[c] / near_dup.LEVELS for s, c in df.items()}
    total = {d: sum(weight[s] * c for s, c in bag.items()) for d, bag in bags.items()}
    holders = collections.defaultdict(list)
    for d, bag in bags.items():
        for s in bag:
            holders[s].append(d)
    both = collections.Counter()
    for s, ds in holders.items():
        for i, a in enumerate(ds):
            for b in ds[i + 1:]:
                both[a, b] += weight[s] * min(bags[a][s], bags[b][s])
    links = [(a, b) for (a, b), x in both.items() if x / (total[a] + total[b] - x) >= 0.8 - 1e-9]
    assert len(links) > 50 and all(classes[a] == classes[b] for a, b in links)
