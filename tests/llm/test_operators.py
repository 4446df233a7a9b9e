"""Each operator against a brute-force version, and on nulls, empty and long texts, ties, repeats, empty tables and clashing names."""

import hashlib
import html
import re
import time
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidebar.llm import common, exact_dedup, html_extract, langid, licenses, mixing, near_dedup, nn_descent, packing, quality, substring_dedup

SF = "/root/testdata/sf0.001"
CLASH = "row h id u hash seed a.b a`b score predicted lang_pred n_langs size copies rate taken start length kept key norm was rest __raw __text __copy __row_hash".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c.replace('`', '``')}` string" for c in CLASH)
PROSE = " ".join(f"word{i % 37} thing{i % 11}" for i in range(60))
ROWS = [
    (5, PROSE, "en", "a"), (3, PROSE + " tail", "en", "a"), (9, PROSE, "en", None), (9, PROSE, "en", None),
    (1, None, None, None), (2, "", "en", "b"), (4, " \t\n ", "de", "b"), (6, "one", "de", "b"), (None, PROSE, "en", "a"), (None, None, None, None),
    (7, "x" * 50_000 + " " + "long words here " * 3000, "fr", "c"), (8, "ONE", "de", "b"), (10, "Released under the MIT License. MIT license", "en", "c"),
    (11, "hello <|endoftext|> world<|startoftext|>x <|ENDOFTEXT|> y\x1cz", "en", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 1, *["x"] * len(CLASH)) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("1 = 0")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_exact_dedup(spark, docs, none):
    got = exact_dedup.exact_dedup(docs).collect()
    assert len(got) == len(ROWS) and exact_dedup.exact_dedup(none).count() == 0
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for i, t, *_ in ROWS:
        groups.setdefault(norm(t), []).append(i)
    by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    for r in got:
        ids = by_sha[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == min((i for i in ids if i is not None), default=None) and r.kept == (r.doc_id == r.keep_id)


def test_exact_dedup_survives_collisions(docs):
    weak = lambda c: F.lit("same")
    assert sorted(map(str, exact_dedup.exact_dedup(docs, hash_of=weak).collect())) == sorted(map(str, exact_dedup.exact_dedup(docs).collect()))


def test_exact_keep_first(docs):
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns and sorted(r.text or "" for r in kept.collect()) == sorted({r[1] or "" for r in ROWS})


def test_exact_dedup_sql(spark):
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    want = sorted(map(tuple, c.sql(exact_dedup.OP10_SQL).fetchall()))
    assert sorted(map(tuple, exact_dedup.op10_exact_dedup(spark, SF).collect())) == want


def brute_near(rows, k):
    sets = {}
    for i, t in rows:
        w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_duplicates(spark, docs, none):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute_near(rows, 2)
    for r in near_dedup.op2_near_dedup(spark, SF).collect():
        assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    got = near_dedup.near_duplicates(docs, 2).collect()
    assert len(got) == len(ROWS) and near_dedup.near_duplicates(none).count() == 0
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[5].component_id == by[9].component_id == by[3].component_id == 3 and by[6].component_id == by[8].component_id == 6
    assert by[1].component_id == 1 and by[2].component_id == 2 and by[4].n_shingles == 0 and by[4].kept
    lost = [r for r in got if r.doc_id is None]
    assert {r.component_id for r in lost} == {3, None}
    kept = near_dedup.keep_first(docs, 2)
    assert kept.columns == docs.columns and 5 not in [r.doc_id for r in kept.collect()]


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    a = np.sort(rng.integers(0, 2**63, 400).astype(np.uint64))
    b = np.sort(np.concatenate([a[:300], rng.integers(0, 2**63, 100).astype(np.uint64)]))
    est = (near_dedup.signature(a) == near_dedup.signature(b)).mean()
    assert abs(est - 300 / 500) < 0.15 and np.isfinite(near_dedup.signature(a[:1])).all()


def test_substring_dedup(spark, docs, none):
    data = spark.read.parquet(f"{SF}/documents.parquet")
    for table in (data, docs):
        rows = [(r.doc_id, r.text) for r in table.collect()]
        first = {}
        for i, t in rows:
            w = words(t)
            for k in range(len(w) - 12):
                if i is not None:
                    first[tuple(w[k : k + 13])] = min(i, first.get(tuple(w[k : k + 13]), i))
        want = []
        for i, t in rows:
            w = words(t)
            gone = set()
            for k in range(len(w) - 12):
                if i is not None and first[tuple(w[k : k + 13])] < i:
                    gone |= set(range(k, k + 13))
            want.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
        for group in (20_000, 40, 1):  # one, two or three lengths of prefixes
            got = substring_dedup.remove_repeats(table, group=group).collect()
            assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)
    assert substring_dedup.remove_repeats(none).count() == 0


def test_substring_dedup_of_many_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    table = spark.range(10_000).select(F.when(F.col("id") < 9_990, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.lit(text).alias("text"))
    got = substring_dedup.remove_repeats(table).groupBy("doc_id").agg(F.count("*").alias("n"), F.max("n_removed").alias("most")).collect()
    assert {r.doc_id: (r.n, r.most) for r in got} == {7: (9_990, 0), **{i: (1, 60) for i in range(9_990, 10_000)}}


def test_deep_suffixes_by_brute_force():
    rng = np.random.default_rng(0)
    for base in (3, 1 << 40):  # keys of many words, and of one
        texts = [rng.integers(0, 3, rng.integers(4, 30)) * (base // 3) for _ in range(40)]
        start = np.cumsum([0, *[len(t) for t in texts]])
        rows = [(start[d] + p, d, tuple(t[p : p + 4])) for d, t in enumerate(texts) for p in range(len(t) - 3)]
        least = {}
        for _, d, w in rows:
            least[w] = min(d, least.get(w, d))
        at, doc = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
        got = substring_dedup.deep_suffixes(np.concatenate(texts), at, np.zeros(len(at), int), doc, 4)
        assert got.tolist() == [d > least[w] for _, d, w in rows]


def test_mixing(spark, docs, none):
    assert mixing.entropy_mix(none, ["doc_id"]).count() == 0
    got = mixing.entropy_mix(docs, docs.columns[:3]).collect()
    assert len(got) == len(ROWS) and all(0 <= r.taken <= 2 * r.size for r in got)
    copies = mixing.mixed_copies(docs)
    assert copies.columns == docs.columns and copies.count() == sum(r.copies for r in got)
    assert len(set(mixing.entropy_mix(docs, docs.columns).columns)) == len(docs.columns) + 2
    twice = mixing.entropy_mix(docs, ["lang", "doc_id"]).collect()  # the order of columns doesn't matter
    assert sorted(map(str, ((r.doc_id, r.size, r.taken) for r in twice))) == sorted(map(str, ((r.doc_id, r.size, r.taken) for r in got)))
    got = mixing.op4_entropy_mix(spark, SF).toPandas()
    data = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    size = {s: sum(len(words(t)) for t in g) for s, g in data.groupby("source").text}
    names = sorted(size)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, left, todo = {}, 1.5 * sum(size.values()), set(names)
    while True:  # share by weight, cap, share again
        part = {s: left * weight[s] / sum(weight[x] for x in todo) for s in todo}
        over = {s for s in todo if part[s] > 2 * size[s]}
        if not over:
            target |= part
            break
        for s in over:
            target[s] = 2 * size[s]
            left -= target[s]
        todo -= over
    source = dict(zip(data.doc_id, data.source, strict=True))
    got["source"] = got.doc_id.map(source)
    for s, g in got.groupby("source"):
        assert np.allclose(g.target, target[s]) and abs(g.taken.sum() - target[s]) <= max(g["size"].max(), 1) and (g.source_size == size[s]).all()
    again = mixing.op4_entropy_mix(spark, SF).toPandas()
    assert sorted(zip(got.doc_id, got.taken, strict=True)) == sorted(zip(again.doc_id, again.taken, strict=True))


def test_rates_are_the_entropy_balance(spark):
    rng = np.random.default_rng(0)
    size = {s: rng.integers(1, 500, 60) for s in "abcd"}
    rows = [(i * 100 + k, "w " * int(n), s) for i, (s, ns) in enumerate(size.items()) for k, n in enumerate(ns)]
    got = mixing.entropy_mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), ["doc_id", "source"]).toPandas()
    for s, g in got.groupby("source"):
        want = g.target.iloc[0]
        assert (g.rate * g["size"]).sum() == pytest.approx(want, rel=1e-5)
        if (g.rate < 2).all():  # one multiplier explains the odds of all documents of the source
            odds = np.log(g.rate / (2 - g.rate)) / g["size"]
            assert np.allclose(odds, odds.mean(), rtol=1e-3) and g.rate.nunique() > 10
        else:
            assert want == pytest.approx(2 * g["size"].sum())


def license_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def test_licenses(spark, docs, none):
    assert licenses.scan_licenses(none).count() == 0
    notice = licenses.NOTICES[0][0]
    texts = [notice, "a " + notice.replace("deal", "trade"), notice.replace("sublicense", "x"), notice[:60], "license mit License gnu cc", "by " * 30 + "cc by cc-BY nc", licenses.NOTICES[4][0], "Apache License, Version 2.0 mit license"]
    odd = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for table in (docs, odd, spark.read.parquet(f"{SF}/documents.parquet")):
        rows = table.select("doc_id", "text").collect()
        sets = [set(license_words(r.text)) for r in rows]
        idf = {w: np.log((len(rows) + 1) / (sum(w in s for s in sets) + 1)) + 1 for t in licenses.TEMPLATES for w in t.words}

        def brute(t):
            w = license_words(t)
            at, base, best = [], [], 0.0
            for x in licenses.TEMPLATES:
                rare = x.rare(idf)
                for s in range(len(w)):
                    if sum(s + q < len(w) and w[s + q] == y for q, y in enumerate(x.words) if y in rare) >= min(2, len(rare)):  # noqa: B023
                        best = max(best, sum(idf[y] for q, y in enumerate(x.words) if s + q < len(w) and w[s + q] == y) / sum(idf[y] for y in x.words))  # noqa: B023
                        if all(w[s + i : s + i + len(m)] == m for i, m in x.must):
                            at.append(x)
                            base += [s] * x.base
            every = ",".join(sorted({x.label for x in at}))
            return len(w), len(base), min(base, default=None), max(base, default=None), ",".join(sorted({x.label for x in at if x.base})), every, round(float(1.0 if every else best), 9)

        plain = [(k, label) for t in [license_words(r.text) for r in rows] for p, label in licenses.BASE.items() for k in range(len(t)) if t[k : k + len(p.split())] == p.split()]
        got = licenses.scan_licenses(table).collect()
        assert sorted(str((*tuple(r)[:7], round(r.score, 9))) for r in got) == sorted(str((r.doc_id, *brute(r.text))) for r in rows)
        assert sum(r.n_base for r in got) == len(plain)
    got = {r.doc_id: r for r in licenses.scan_licenses(odd).collect()}
    assert got[100].labels == "mit" and got[101].labels == "" and 0.5 < got[101].score < 1 and got[102].labels == "mit" and got[106].labels == "gpl,gpl-3" and got[107].labels == "apache,apache-2.0,mit"


def test_licenses_in_linear_time(spark):
    took = []
    for n in (1000, 20_000, 40_000):
        table = spark.createDataFrame([(1, "mit license " * n)], "doc_id long, text string")
        began = time.perf_counter()
        assert licenses.scan_licenses(table).first().n_base == n
        took.append(time.perf_counter() - began)
    assert took[2] < 3 * took[1] + 5


def test_language(spark, docs, none):
    got = langid.op1_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.95
    model = langid.fit(docs)
    out = langid.identify(docs, model, [F.col("doc_id")]).collect()
    assert len(out) == len(ROWS) and all(r.lang_pred == "und" and r.score == 0 for r in out if r.doc_id in (1, 2, 4)) and all(0 <= r.score <= 1 for r in out)
    assert all(r.lang_pred == "und" for r in langid.identify(docs, langid.fit(none), [F.col("doc_id")]).collect())
    assert langid.identify(none, model, [F.col("doc_id")]).count() == 0


def test_language_mixture():
    rng = np.random.default_rng(0)
    text = lambda letters: " ".join("".join(rng.choice(list(letters), 5)) for _ in range(200))
    counts = np.stack([np.bincount(langid._grams(text(x).encode())[0], minlength=langid.BUCKETS) for x in ("abcdef", "uvwxyz")])
    best, score, kinds = langid.Model(["p", "q"], counts).predict([text("abcdef").encode(), (text("abcdef") + " " + text("uvwxyz")[:500]).encode(), b"42"])
    assert best.tolist() == [0, 0, -1] and kinds.tolist() == [1, 2, 0] and 0.6 < score[1] < 0.8


def test_language_by_brute_force(spark):
    from itertools import combinations

    data = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(data)
    rows = {r.doc_id: r.text for r in data.collect()}
    counts = np.zeros((len(model.langs), langid.BUCKETS))
    for r in data.where("text IS NOT NULL AND lang IS NOT NULL").collect():
        np.add.at(counts[model.langs.index(r.lang)], langid._grams(r.text.encode())[0], 1)
    logp = np.log((counts + 0.25) / (counts.sum(1, keepdims=True) + 0.25 * langid.BUCKETS))
    same = 0
    got = {r.doc_id: r for r in langid.identify(data, model, [F.col("doc_id")]).collect()}
    for i, text in rows.items():
        g, first = langid._grams((text or "").encode())
        if not re.search(r"[^\W\d_]", text or "") or not len(g):
            same += got[i].lang_pred == "und"
            continue
        words = np.add.reduceat(logp[:, g], np.flatnonzero(first), axis=1)  # languages x words
        best = (-np.inf, None, None)
        for n in range(1, len(model.langs) + 1):
            for pick in combinations(range(len(model.langs)), n):
                ll = words[list(pick)]
                part = np.full(n, 1 / n)
                for _ in range(20):
                    p = np.log(part)[:, None] + ll
                    p = np.exp(p - p.max(0))
                    part = np.maximum((p / p.sum(0)).mean(1), 1e-12)
                value = np.logaddexp.reduce(np.log(part)[:, None] + ll, axis=0).sum() - 0.5 * np.log(words.shape[1] + 1) * (n - 1)
                if value > best[0] + 1e-6:
                    best = (value, pick[part.argmax()], n)
        same += got[i].lang_pred == model.langs[best[1]] and got[i].n_langs == best[2]
    assert same >= 0.97 * len(rows)  # the operator drops languages one by one instead of trying every set


def test_quality(spark, docs, none):
    got = quality.op3_quality(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.95
    labels = spark.createDataFrame([(5, 1), (7, 0), (7, 0), (None, 1), (3, None)], "doc_id long, quality int")
    field = quality.fit(docs, labels)
    out = quality.score_quality(docs, field, [F.col("doc_id")]).collect()
    assert len(out) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    assert quality.score_quality(none, quality.fit(docs, labels.where("1 = 0")), [F.col("doc_id")]).count() == 0


def test_field_marginals_by_enumeration():
    rng = np.random.default_rng(0)
    unary, trans = rng.normal(size=4), rng.normal(size=(2, 2))
    field = quality.Field(np.zeros(1), trans, np.zeros(1), np.ones(1))
    good, pairs, log_z = field.marginals(np.concatenate([unary, unary[:1]]), np.array([4, 1]))
    total, want = 0.0, np.zeros(4)
    for k in range(16):
        y = [(k >> i) & 1 for i in range(4)]
        p = np.exp(sum(u * v for u, v in zip(unary, y, strict=True)) + sum(trans[a, b] for a, b in zip(y, y[1:], strict=False)))
        total += p
        want += p * np.array(y)
    assert np.allclose(good[:4], want / total) and good[4] == pytest.approx(1 / (1 + np.exp(-unary[0]))) and pairs.sum() == pytest.approx(3)


def test_packing(spark, docs, none):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_file())
    for table in (docs, spark.read.parquet(f"{SF}/documents.parquet")):
        table = table.coalesce(1).withColumn("uid", F.monotonically_increasing_id())  # repeated rows and rows without an id stay apart
        texts = {r.uid: r.text or "" for r in table.collect()}
        got = packing.pack(table, packing.tokenizer_file(), [common.column(c) for c in table.columns if c != "text"]).toPandas()
        assert set(got.uid) == set(texts) and len(set(got.columns)) == len(got.columns)
        for i, g in got.sort_values("start").groupby("uid"):
            ids = np.array([*t.encode(texts[i], add_special_tokens=False).ids, 1], "<u4")
            assert (g.doc_tokens == len(ids)).all() and g.start.tolist() == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() == len(ids)
            assert all(zlib.crc32(ids[a : a + n].tobytes()) == c for a, n, c in zip(g.start, g.length, g.ids_crc32, strict=True))
        for _, g in got.sort_values("offset").groupby("sequence_id"):
            assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() <= 2048
        n = got.groupby("sequence_id").length.sum()
        assert sum(0 if x & (x - 1) == 0 else 2048 - x for x in n) < 0.03 * n.sum()
    assert packing.pack(none, packing.tokenizer_file(), [F.col("doc_id")]).count() == 0


def test_word_store_keeps_ids_when_it_turns_over():
    small, large = packing.WordTokenizer(packing.tokenizer_file(), 1000, 100), packing.WordTokenizer(packing.tokenizer_file())
    texts = [" ".join(f"word{i % 7} Thing{i * k}" for i in range(20)) for k in range(30)]
    texts += ["", " ", " a\t\nb ", "x <|endoftext|> y", "x\x1dy", "\u0301e e\u0301"] + [f"a{chr(c)}b" for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    want = [large.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for words in (small, large):
        assert [x.tolist() for x in words.encode(pa.array(texts))] == want
    assert len(small.known) + len(small.older) < len(large.known)


def test_cuts_fall_on_sentences():
    words = packing.WordTokenizer(packing.tokenizer_file())
    packer = packing.Packer(256, 64, 4.0, 32.0, 1 << 12)
    (ids,) = words.encode(pa.array(["This is a sentence of some words. " * 400]))
    got = [*packer.add("x", ids, words.stop[ids].copy()), *packer.cut(True)]
    ends = np.cumsum([n for _, _, n, *_ in got])
    assert len(got) > 10 and all(words.stop[ids[e - 1]] == 1 for e in ends[:-2])


def test_cuts_are_optimal():
    rng = np.random.default_rng(0)
    for _ in range(30):
        ends = np.unique(np.append(np.arange(3, 60, 3), rng.integers(1, 60, 10)))
        cost = rng.integers(0, 6, len(ends)).astype(float)
        cost[-1] = 0
        at, pay, best = [0, *ends], [0, *cost], [0.0]
        for j in range(1, len(at)):
            best.append(min(best[i] + 16 - (at[j] - at[i]) + pay[j] for i in range(j) if at[j] - at[i] <= 16))
        cuts = packing.best_cuts(ends, cost, 16, False, 9.0)
        spent = sum(16 - (b - a) for a, b in zip([0, *cuts], cuts, strict=False)) + sum(dict(zip(ends, cost, strict=True))[c] for c in cuts)
        assert spent == pytest.approx(best[-1])


def test_html(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, ""), (None, "u", "<p>a&amp;b<br>c"), (4, "u", "<nav>n</nav>"), (4, "u", "<nav>n</nav>")], "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("kept", F.lit("clash"))
    for keep in (("page_id", "url"), ("page_id", "url", "text", "kept")):
        got = html_extract.extract_pages(pages, keep).collect()
        assert sorted(r.text for r in got) == ["", "", "", "", "a&b c"] and all(r.n_chars == len(r.text) for r in got)
    assert html_extract.extract_pages(pages.where("1 = 0")).count() == 0
    page = "<html><header>H</header><div class='cookie-notice'>we use cookies</div><article><h1>Title</h1><p>First &lt;long&gt; paragraph of the article.<p>Be.</p><div class=ad>buy</div><form>f</form></article><aside>s</aside><section id=comments><p>nice</p></section><footer>F</footer><script>x</script>"
    assert html_extract.extract(page) == "Title\nFirst <long> paragraph of the article.\nBe."


def test_html_by_planted_articles(spark):
    def brute(page):
        body = re.search(r"<article>(.*?)(</article>|<footer>)", page, re.S)[1]
        body = re.sub(r"<(script|style).*?</\1>|<!--.*?-->", "", body, flags=re.S).replace("<br>", " ")
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", "", x))).strip() for x in re.split(r"</?(?:p|h1)[^>]*>", body)]
        return "\n".join(filter(None, parts))

    want = {r.page_id: brute(r.html) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    assert {r.page_id: r.text for r in html_extract.op5_html_extraction(spark, "/root/testdata/sf0.01").collect()} == want


def test_html_ratios_decide():
    long = lambda k: f"<p>{f'Some sentence number {k} of a paragraph, and it goes on. ' * 6}</p>"
    links = "".join(f"<li><a href=x>Another page {k}</a></li>" for k in range(8))
    # without any telling name: a list of links beside the text, one below it, and a paragraph that is a link
    page = f"<body><div><ul>{links}</ul></div><div>{long(1)}<p><a href=y>The source of this</a></p>{long(2)}<ul>{links}</ul></div></body>"
    got = html_extract.extract(page).split("\n")
    assert len(got) == 3 and got[1] == "The source of this" and "number 2" in got[2]
    assert len(html_extract.extract(page, sigma=0).split("\n")) == 2  # the smoothed ratio of the link paragraph is its neighbours'
    assert len(html_extract.extract(page, threshold=0).split("\n")) > 10  # all lines are content


def test_html_in_linear_time():
    for piece in ("<font>x<div>y", "<b></i><li></li>", "<p>a<ul><li>", "<td><font></b>", "<!--", "<![x", "<", "&", "<a href='"):
        began = time.perf_counter()
        html_extract.extract(piece * (1_000_000 // len(piece)))
        assert time.perf_counter() - began < 20, piece


def test_nearest(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 8)).round(3)
    x[100:140] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1020, [0.0] * 8), (1040, [float("nan")] * 8), (1060, [None] * 8), (1080, [1.0]), (None, [1.0] * 8), (1100, [])]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, u string")
    got = nn_descent.nearest(table, lambda i: i % 20 == 0, k=20).toPandas()
    hit = 0
    for q in range(0, 600, 20):
        s = x @ x[q]
        order = [i for i in np.lexsort((np.arange(600), -s.round(9))) if i != q][:20]
        g = got[got.query_id == q].sort_values("rank")
        assert g["rank"].tolist() == list(range(1, 21)) and np.allclose(g.score, s[g.vec_id]) and (np.diff(g.score) <= 0).all() and q not in g.vec_id.tolist()
        hit += len(set(order) & set(g.vec_id))
    assert hit / 600 > 0.9 and set(got.query_id) == set(range(0, 600, 20))
    few = nn_descent.nearest(table.where("vec_id in (0, 1, 2, 100)"), lambda i: i % 20 == 0, k=20).toPandas()
    assert few.groupby("query_id").size().to_dict() == {0: 3, 100: 3}
    assert nn_descent.nearest(table.where("1 = 0"), lambda i: i % 20 == 0).count() == 0


def test_recall_on_embeddings(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas().dropna()
    x = np.stack(table.embedding.to_numpy()).astype(float)
    got = nn_descent.op6_nearest_neighbours(spark, "/root/testdata/sf0.1").toPandas()
    scores = x[table.vec_id % 20 == 0] @ x.T
    ids = table.vec_id.to_numpy()
    hit = 0
    for q, s in zip(ids[ids % 20 == 0], scores, strict=True):
        s[ids == q] = -np.inf
        g = got[got.query_id == q].sort_values("rank")
        hit += (g.score >= np.sort(s)[-20] - 1e-9).sum()
    assert hit >= 0.95 * len(got) and got.groupby("query_id").size().eq(20).all()


def test_word_hashes():
    a = np.frombuffer("Ab cd\tAB  ef".encode(), np.uint8)
    h, low = common.word_hashes(a), common.word_hashes(a, lower=True)
    assert len(h) == 4 and h[0] != h[2] and low[0] == low[2] and h[1] == low[1]


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = common.cut(stage(spark, before, SF), "test")
        assert after.columns == docs.columns, name
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()}
        if name == "exact dedup":
            assert after.count() == len({re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in before.collect()})
        if name == "near dedup":
            want = brute_near([(r.doc_id, r.text) for r in before.collect()], 5)
            assert ids == {i for i, (_, root) in want.items() if i == root}
        before = after
    assert corpus_pipeline.STAGES[-1][1](spark, before, SF).where("start = 0").count() == before.count()
