"""The corpus operators against SQL, brute force and the library, and on odd rows."""

import re
from collections import Counter, defaultdict
from hashlib import md5, sha256

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from conftest import DATA, by_sql, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from cellweave.llm import bpe, jaccard, langid, licenses, mixing, permutation, queries, urlrules, vectors, warc, wordpiece
from cellweave.llm.common import table
from cellweave.llm.components import components, roots
from cellweave.llm.common import Workspace

BPE = public_tokenizers.path("byte_bpe_50k.json")
ODD = [(1, None, None, None), (2, "", "en", "src1"), (3, "one", "en", "src1"), (3, "one", "en", "src1"), (4, "x " * 3000, None, "odd"), (None, "one two", "fr", None), (5, "Ünï İ 12 \u2003 \x1c\x85", "de", "src0")]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).withColumn("ids", F.lit("clash")).withColumn("score", F.lit(1))


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or ""))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    assert rows(queries.QUERIES[name](spark, DATA).toPandas()) == rows(by_sql(queries.ORACLE_SQL[name]))


# BPE


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_bpe_encodes_as_the_library(text):
    e, t = bpe.encoder(BPE), Tokenizer.from_file(BPE) if not hasattr(bpe, "_t") else bpe._t
    bpe._t = t
    want = t.encode(text, add_special_tokens=False).ids
    assert e.ids(e.encode_batch([text])[0]) == want and e.decode(want) == t.decode(want, skip_special_tokens=False)


def test_bpe_runs_and_specials(library):
    e = bpe.encoder(BPE)
    for s in ("aaaaaaa aaaa", "x<|endoftext|>y  <|endoftext|>", "\n\n \t a", "don't I'LL"):
        assert e.ids(e.encode_batch([s])[0]) == library.encode(s, add_special_tokens=False).ids


def test_bpe_query_and_odd_rows(spark, odd, library):
    docs = table(spark, DATA, "documents").select("doc_id", "text")
    for d in (docs, odd.select("doc_id", "text")):
        got = Counter(tuple(r) for r in bpe.digests(d, BPE).collect())
        want = Counter()
        for r in d.collect():
            ids = library.encode(r.text or "", add_special_tokens=False).ids
            want[(r.doc_id, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())] += 1
        assert got == want
    both = bpe.decode(bpe.encode(odd.select("doc_id", "text"), BPE), BPE).collect()
    assert all(r.decoded == (r.text or "") for r in both) and bpe.digests(odd.limit(0), BPE).count() == 0


# piece counts


def test_piece_counts_match_greedy_search(spark, odd):
    a = wordpiece.automaton(BPE)
    pieces = set(wordpiece.byte_level_pieces(BPE))
    longest = max(map(len, pieces))

    def greedy(w):
        i = n = 0
        while i < len(w):
            i += next(k for k in range(min(longest, len(w) - i), 0, -1) if w[i : i + k] in pieces)
            n += 1
        return n

    for d in (table(spark, DATA, "documents"), odd):
        want = Counter((r.doc_id, len((r.text or "").split()), sum(greedy(b" " + w.encode()) for w in (r.text or "").split())) for r in d.collect())
        assert Counter(tuple(r) for r in wordpiece.piece_counts(d, BPE).collect()) == want
    assert a.count(b" " + b"abc" * 100) == greedy(b" " + b"abc" * 100)
    small = wordpiece.Automaton([b"a", b"ab", b"abc", b"c"])
    assert small.counts([b"abcab", b"abx", b""]).tolist() == [2, 1, 0]


def test_continuation_pieces_match_the_library(spark, odd, tmp_path):
    texts = [r.text or "" for r in table(spark, DATA, "documents").limit(300).collect()]
    often = Counter(w for t in texts for w in t.split())
    heads = {w[:k] for w, _ in often.most_common(400) for k in (1, 2, 4, len(w))}
    inner = {"##" + w[k : k + n] for w, _ in often.most_common(400) for k in (1, 2, 3) for n in (1, 2, 4)} - {"##"}
    vocab = {t: i for i, t in enumerate(["[UNK]", *sorted(heads | inner)])}
    model = Tokenizer(models.WordPiece(vocab, unk_token="[UNK]", max_input_chars_per_word=1 << 30))
    model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    path = str(tmp_path / "words.json")
    model.save(path)
    a = wordpiece.Automaton(*wordpiece.word_pieces(path), lead=b"")
    words = [*often, "a" * 500, "Zürich-Öße", "\u0416x"]
    assert a.counts([w.encode() for w in words]).tolist() == [len(model.encode(w).ids) for w in words]
    assert [a.count(w.encode()) for w in words] == [len(model.encode(w).ids) for w in words]
    docs = table(spark, DATA, "documents").limit(300)
    got = {r.doc_id: r.n_pieces for r in wordpiece.piece_counts(docs, path).collect()}
    assert got == {r.doc_id: len(model.encode(r.text or "").ids) for r in docs.collect()} and len(set(got.values())) > 9
    clash = odd.select("doc_id", "text", F.lit(1).alias("n_words"), F.lit(2).alias("n_pieces"))
    assert wordpiece.piece_counts(clash, path).columns == ["doc_id", "n_words", "n_pieces"] and wordpiece.piece_counts(clash.limit(0), path).count() == 0


# licences


def test_templates_longer_than_a_stride(spark):
    long = licenses.Template("whole", " ".join(f"term{i}" for i in range(150)), 0.9)
    filler = " ".join(f"other{i}" for i in range(97))
    held = filler + " " + " ".join(f"term{i}" for i in range(0, 140)) + " " + filler
    rows = [(1, held, None, None), (2, held.replace("term7 ", "x ").replace("term139", "x").replace("term1 ", "x "), None, None), (3, "term1 " * 500, None, None), (4, filler, None, None)]
    d = spark.createDataFrame([(*r,) for r in rows], SCHEMA)
    got = {r.doc_id: (r.labels, round(r.score, 6)) for r in licenses.scan(d, [*licenses.TEMPLATES, long]).collect()}
    assert got == {1: ("whole", round(140 / 150, 6)), 2: ("whole", round(137 / 150, 6)), 3: ("", 0.0), 4: ("", 0.0)}


def brute_scan(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))
    base, labels, places, best = set(), set(), [], 0.0
    for t in licenses.TEMPLATES:
        p = t.words
        if t.phrase:
            at = [i for i in range(len(w)) if w[i : i + len(p)] == p]
            if at:
                places, best = places + at, 1.0
                base.add(t.label), labels.add(t.label)
            continue
        for b in range(0, len(w), licenses.STRIDE):
            share = len(set(w[b : b + 2 * licenses.STRIDE]) & set(p)) / len(set(p))
            if share >= t.threshold - 1e-9:
                labels.add(t.label)
                best = max(best, share)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), round(best, 9)


def test_license_scan_matches_brute_force(spark, odd):
    far = "word " * 62 + "under the MIT License " + "w " * 70 + "CC BY-NC cc by nc Apache License, Version 2.0 " + licenses.TEMPLATES[3].text
    more = spark.createDataFrame([(9, far, None, None)], SCHEMA)
    for d in (table(spark, "/root/testdata/sf0.01", "documents").limit(400), odd, more):
        got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9)) for r in licenses.scan(d).collect())
        assert got == Counter((r.doc_id, *brute_scan(r.text)) for r in d.collect())
    assert licenses.scan(odd.limit(0)).count() == 0


# language


def test_language_of_held_out_documents(spark, odd):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = {r.doc_id: r for r in langid.predict_all(docs).collect()}
    held = [r for r in docs.collect() if got[r.doc_id].held_out]
    assert len(got) == docs.count() and np.mean([got[r.doc_id].lang_pred == r.lang for r in held]) > 0.97
    m = langid.train(docs)
    en, fr = (next(r.text for r in held if r.lang == x and len(r.text) > 1500)[:1500] for x in ("en", "fr"))
    lang, score, shares = m.predict([en + " " + fr, None, "12 ..", en])
    assert lang[1:] == ["und", "und", "en"] and score[1:3] == [0, 0] and min(shares[0][m.languages.index(x)] for x in ("en", "fr")) > 0.4
    assert {r.lang_pred for r in langid.predict_all(odd.filter("lang IS NULL")).collect()} == {"und"}
    assert langid.predict_all(odd).count() == len(ODD) and langid.keep_identified(odd, 0.3).columns == odd.columns


FOREIGN = {
    "ru": "Съешь же ещё этих мягких французских булок, да выпей чаю. " * 4,
    "el": "Ξεσκεπάζω την ψυχοφθόρα βδελυγμία του κόσμου αυτού. " * 4,
    "ja": "いろはにほへと ちりぬるを わかよたれそ つねならむ うゐのおくやま。" * 4,
    "pl": "Zażółć gęślą jaźń, wszystko dobrze się kończy w tym pięknym świecie. " * 4,
    "hex": " ".join(f"{x * 2654435761 % 2**32:08x}" for x in range(1, 40)),
    "consonants": " ".join("".join("bcdfghjklmnpqrstvwxz"[(7 * i + i * j * j + 3 * j) % 20] for j in range(8)) for i in range(1, 40)),
}


def test_other_languages_and_gibberish_are_rejected_and_clean_documents_kept(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    clean = docs.count()
    odd = spark.createDataFrame([(-i - 1, t, None) for i, t in enumerate(FOREIGN.values())], "doc_id long, text string, lang string")
    assert {r.doc_id for r in langid.keep_identified(docs.union(odd), 0.3).collect()} == {r.doc_id for r in docs.collect()} and clean > 100
    # a language without labels is not learned, so its documents go
    for lang in ("fr", "de"):
        hidden = docs.withColumn("lang", F.when(F.col("lang") != lang, F.col("lang")))
        kept = Counter(r.lang for r in langid.keep_identified(hidden, 0.3).collect())
        assert kept[None] <= 0.03 * docs.filter(F.col("lang") == lang).count() and clean - docs.filter(F.col("lang") == lang).count() == sum(n for x, n in kept.items() if x)


# mixing


def test_mixing_keeps_budgets_and_whole_rows(spark, odd):
    got = mixing.mixture(odd).collect()
    assert len(got) == len(ODD) and all(r.copies >= 0 for r in got) and mixing.mixture(odd.limit(0)).count() == 0
    docs = mixing.mixture(table(spark, "/root/testdata/sf0.01", "documents")).toPandas()
    used = (docs.tokens * docs.copies).groupby([docs.domain, docs.lang, docs.source]).sum()
    assert (used <= docs.groupby(["domain", "lang", "source"]).leaf_budget.first()).all()


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", "s", 10), ("a", "y", "s", 1000), ("b", "x", "s", 1000)], "domain string, lang string, source string, total long")
    mix = mixing.Mixture(domain={}, lang={}, percent=20, epochs=1)
    got = {(r.domain, r.lang): r.budget for r in mixing.budgets(leaves, mix).collect()}
    assert got == {("a", "x"): 10, ("a", "y"): 191, ("b", "x"): 201}


# vectors


def test_near_duplicates_match_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((12, 64))
    x = [base[i % 12] + rng.standard_normal(64) * s for i, s in enumerate(np.linspace(0, 0.35, 240))]
    x = [v.astype(np.float32) for v in x] + [base[0].astype(np.float32)] * 5
    data = [(i, v.tolist(), i % 12 % 3) for i, v in enumerate(x)]
    e = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in vectors.near_duplicates(e, split=8).collect()}
    u = np.stack(x).astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    lab = np.array([d[2] for d in data])
    link = (u @ u.T >= 0.93) & (lab[:, None] == lab[None]) & ~np.eye(len(u), dtype=bool)
    n = np.array([got[i].n_links for i in range(len(u))])
    assert (n <= link.sum(1)).all() and n.sum() >= 0.9 * link.sum()
    assert [got[i].component_id for i in range(len(u))] == roots(len(u), *np.nonzero(link)).tolist()


@pytest.mark.parametrize("cosine, least", [(0.93, 0.997), (0.935, 0.998), (0.94, 0.999), (0.95, 0.9995)])
def test_pairs_near_the_threshold_share_a_table(cosine, least):
    rng = np.random.default_rng(5)
    x, y = rng.standard_normal((2, 20000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(1, keepdims=True) * x
    y = cosine * x + np.sqrt(1 - cosine**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    hit = [(vectors.codes(x[i : i + 4000]) == vectors.codes(y[i : i + 4000])).any(1) for i in range(0, len(x), 4000)]
    assert np.mean(hit) >= least


def test_vectors_that_link_with_nothing(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, None, 1), (5, [0.0, 0.0], 1), (6, [float("nan"), 1.0], 1), (7, [1.0, None], 1), (9, [1.0, 0.0, 0.0], 1), (10, [1.0, 0.0], None)], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: tuple(r)[1:] for r in vectors.near_duplicates(q).collect()}
    assert got[1] == (1, 1, True) and got[2] == (1, 1, False) and all(got[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 9, 10))
    assert vectors.near_duplicates(q.limit(0)).count() == 0


def test_nearest_neighbours(spark):
    e = table(spark, "/root/testdata/sf0.01", "embeddings")
    p = e.toPandas().sort_values("vec_id")
    x, ids = np.stack(p.embedding).astype(np.float64), p.vec_id.to_numpy()
    for share, least in ((permutation.SHARE, 0.9), (1.0, 1.0)):
        got = defaultdict(list)
        for r in permutation.nearest(e, F.col("vec_id") % 100 == 0, share=share).orderBy("query_id", "rank").collect():
            got[r.query_id].append((r.vec_id, r.score))
        hit = 0
        for i in np.flatnonzero(ids % 100 == 0):
            d = np.sqrt(((x - x[i]) ** 2).sum(1))
            d[i] = np.inf
            hit += len({v for v, _ in got[ids[i]]} & set(ids[np.lexsort((ids, d))[:10]]))
            assert all(d[np.searchsorted(ids, v)] == s for v, s in got[ids[i]])
        assert hit >= least * 10 * len(got)
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (100, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r)[:3] for r in permutation.nearest(few, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()] == [(0, 1, 1), (0, 2, 100), (100, 1, 0), (100, 2, 1)]


def test_recall_where_the_share_decides():
    x, ids = np.random.default_rng(2).standard_normal((8000, 64)), np.arange(8000)
    asked = ids[::200]
    block = permutation.Block(ids, x, x[np.random.default_rng(3).permutation(8000)[: permutation.PIVOTS]])
    hit = 0
    for n, found, _ in block.search(x[asked], asked, permutation.SHARE, 10):
        d = ((x - x[asked[n]]) ** 2).sum(1)
        d[asked[n]] = np.inf
        hit += len(set(found.tolist()) & set(np.argsort(d)[:10].tolist()))
    assert hit >= 0.9 * 10 * len(asked)


def test_files_rank_by_footrule():
    rng = np.random.default_rng(4)
    x, pivots, m = rng.standard_normal((300, 8)), rng.standard_normal((24, 8)), 6
    block = permutation.Block(np.arange(300), x, pivots, m)
    q = rng.standard_normal(8)
    place = lambda v: dict(zip(permutation.nearest_pivots(v[None], pivots, m)[0].tolist(), range(m), strict=True))
    of_q = place(q)
    footrule = np.array([sum(abs(of_x.get(p, m) - of_q.get(p, m)) for p in range(24)) for of_x in map(place, x)])
    some = np.lexsort((np.arange(300), footrule))[:30]
    want = sorted((np.sqrt(((x[i] - q) ** 2).sum()), i) for i in some)[:5]
    ((_, found, d),) = block.search(q[None], np.array([-1]), 0.1, 5)
    assert found.tolist() == [i for _, i in want] and np.allclose(d, [w for w, _ in want], rtol=1e-12)


def test_neighbours_of_odd_rows(spark):
    assert permutation.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 100 == 0).count() == 0
    data = [(0, [1.0, 0.0], 1, 1), (0, [0.0, 1.0], 2, 2), (1, [1.0, 0.0], 3, 3), (2, [1.0, 0.0, 0.0], 4, 4), (None, [1.0, 0.0], 5, 5), (100, [1.0, 0.0, 0.5], 6, 6)]
    e = spark.createDataFrame(data, "vec_id long, embedding array<double>, uid long, score long")
    got = Counter(tuple(r) for r in permutation.nearest(e, F.col("vec_id") % 100 == 0).collect())
    assert got == Counter([(0, 1, 1, 0.0), (0, 1, 1, 2**0.5), (100, 1, 2, 0.5)])


def test_near_duplicates_of_repeated_ids(spark):
    data = [(5, [1.0, 0.0], "a"), (7, [1.0, 0.01], "a"), (5, [0.0, 1.0], "b"), (9, [0.01, 1.0], "b"), (5, [-1.0, 0.0], "a")]
    for kind in ("float", "double"):
        q = spark.createDataFrame(data, f"vec_id long, embedding array<{kind}>, label string")
        got = Counter(tuple(r) for r in vectors.near_duplicates(q).collect())
        assert got == Counter([(5, 1, 5, True), (7, 1, 5, False), (5, 1, 5, True), (9, 1, 5, False), (5, 0, 5, True)])


# URLs


def test_url_rules_on_odd_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.ORG/es/?a", "x://a.example.org/en/12#f", "x://notexample.org/es/", "x://org?/q", "x://b.com/de/x", "x://b.com:80/de/x", "a://b://c.com/fr/"]
    d = spark.createDataFrame([(i // 2, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = [tuple(r)[1:] for r in urlrules.judge(d).orderBy("page_id", "host", "path").collect()]
    assert ("example.org", "/es/", "example.org/es/", "block") in got and ("a.example.org", "/en/12", "example.org/en/1", "block") in got
    assert ("notexample.org", "/es/", "org/", "allow") in got and ("org", "", None, "allow") in got and ("b.com:80", "/de/x", None, "allow") in got
    assert len(got) == len(urls) and got.count(("", "", None, "allow")) >= 4 and urlrules.judge(d.limit(0)).count() == 0


# Jaccard


def brute_join(docs):
    sets = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0d]+", low(t))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    ids = sorted(sets)
    pairs = [(a, b) for a in range(len(ids)) for b in range(a) if sets[ids[a]] and sets[ids[b]] and 100 * len(sets[ids[a]] & sets[ids[b]]) >= 75 * len(sets[ids[a]] | sets[ids[b]])]
    root = roots(len(ids), *(np.array(x, dtype=int) for x in zip(*pairs, strict=True))) if pairs else np.arange(len(ids))
    return {i: (len(sets[i]), ids[root[k]]) for k, i in enumerate(ids)}


def test_jaccard_join_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    made = []
    for i in range(150):
        words = [f"w{x}" for x in rng.integers(0, 5000, rng.integers(1, 120))]
        made.append(" ".join(words))
        for _ in range(i % 4):
            for _ in range(rng.integers(0, 4)):
                words[rng.integers(len(words))] = f"v{rng.integers(1 << 30)}"
            made.append(" ".join(words).upper() + "\n")
    texts = [*made, *[made[0]] * 3, "", "  \t", "a b", "A  b"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(d).collect()}
    assert got == brute_join(enumerate(texts))


def hot_texts(rng, n, length, passage):
    """Near copies of one text with 0 to 30 % of their words edited, some of them copied and edited again, and
    texts that share a passage but little else."""
    base = [f"b{x}" for x in rng.integers(0, 5000, length)]
    made = [base]
    for k in range(n):
        words = list(base if k % 4 else made[rng.integers(len(made))])
        for _ in range(rng.integers(0, max(2, len(words) * 3 // 50))):
            at, new = rng.integers(len(words)), f"v{rng.integers(1 << 30)}"
            words[at : at + rng.integers(0, 2)] = [new][: rng.integers(0, 2)]
        made.append(words[: len(words) - rng.integers(0, len(words) // 5) * (k % 7 == 0)])
    common = [f"c{x}" for x in range(passage)]
    for k in range(n):
        own = [f"o{rng.integers(1 << 30)}" for _ in range(rng.integers(passage // 4, 2 * passage))]
        made.append([*own[: k % 9], *common[k % 5 :], *own[k % 9 :]])
    return [" ".join(w) for w in made]


@pytest.mark.parametrize(("seed", "length", "short"), [(1, 120, 16), (2, 30, 2), (3, 60, 0)])
def test_jaccard_join_of_hot_groups_matches_brute_force(spark, monkeypatch, seed, length, short):
    monkeypatch.setattr(jaccard, "SHORT", short)
    monkeypatch.setattr(jaccard, "STAR", 16)
    texts = hot_texts(np.random.default_rng(seed), 150, length, 40)
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(d).collect()}
    want = brute_join(enumerate(texts))
    assert got == want and len({c for _, c in want.values()}) > 50


def test_deduplicate_goes_by_row(spark):
    text = lambda a, n: " ".join(f"{a}{i}" for i in range(n))
    data = [(1, text("a", 40), "x"), (2, text("a", 40) + " end", "x"), (2, text("b", 40), "y"), (3, text("c", 40), "z"), (3, text("c", 40), "y"), (None, text("a", 40), "x"), (None, text("d", 40), "x"), (4, None, "x"), (5, "", "x"), (5, "", "x"), (6, None, None)]
    d = spark.createDataFrame(data, "doc_id long, text string, component_id string")
    got = Counter(tuple(r) for r in jaccard.deduplicate(d).collect())
    assert got == Counter([data[0], data[2], data[4], data[6], data[7], data[8], data[10]])
    assert jaccard.deduplicate(d.limit(0)).count() == 0


def test_jaccard_on_odd_rows(spark, odd):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join(odd).collect())
    assert got == Counter({(1, 0, 1): 1, (2, 0, 2): 1, (3, 1, 3): 2, (4, 1, 4): 1, (None, 0, None): 1, (5, 1, 5): 1})
    assert jaccard.join(odd.limit(0)).count() == 0


def test_jaccard_with_two_texts_under_one_id(spark):
    text = lambda a, n: " ".join(f"{a}{i}" for i in range(n))
    data = []
    for k in range(20):
        # the id stands on two dissimilar texts, in either order, each near to one other document
        one, two = text(f"p{k}x", 60), text(f"q{k}x", 60)
        data += [(4 * k, t) for t in ((one, two) if k % 2 else (two, one))] + [(4 * k + 1, one + " end"), (4 * k + 2, two + " end")]
    got = Counter(tuple(r) for r in jaccard.join(spark.createDataFrame(data, "doc_id long, text string").coalesce(1)).collect())
    assert got == Counter(x for k in range(20) for x in ((4 * k, 56, 4 * k), (4 * k, 56, 4 * k), (4 * k + 1, 57, 4 * k), (4 * k + 2, 57, 4 * k)))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 300)] + [(5, 5)]
    for at_most in (0, 1 << 17):
        found = components(spark.createDataFrame(edges, "a long, b long"), Workspace(spark), at_most=at_most)
        got = {r.node: r.component for r in found.collect()}
        assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(200, 300)} == {7}


# WARC


def test_warc_records_round_trip(spark):
    raw = warc.record(7, "http://a/ b\n", b"\r\n\r\nWARC/1.1", "00" * 20, None)
    head, http, payload = warc.parse(raw)
    assert payload == b"\r\n\r\nWARC/1.1" and head["warc-target-uri"] == "http://a/%20b%0A" and warc.url_key("x://b.A.org/P?q") == "org,a,b)/P?q"
    p = spark.createDataFrame([(1, None, None), (2, "x://h/ \n", "é" * 600), (3, "x://h/", "é" * 600), (3, "x://h/", "é" * 600), (None, "", "é" * 600), (5, "x://h/", "short")], "page_id long, url string, html string")
    got = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(p).collect())
    assert got == Counter({(1, 0, "response", None): 1, (2, 1200, "revisit", 3): 1, (3, 1200, "response", None): 2, (None, 1200, "revisit", 3): 1, (5, 5, "response", None): 1})
    assert warc.round_trip(p.limit(0)).count() == 0


# the pipeline


def plain_mixture(model, text):
    """Language, share and whether it fits, by EM over segments written out one document at a time."""
    bucket, _, n_letters = langid.grams([text])
    if not len(bucket) or not n_letters[0]:
        return "und", 0.0
    segments = [bucket[i : i + langid.GRAMS] for i in range(0, len(bucket), langid.GRAMS)]
    ll = np.array([[sum(float(model.log_p[b, k]) for b in s) for k in range(len(model.languages))] for s in segments])

    def fit(chosen):
        pi = {k: 1 / len(chosen) for k in chosen}
        like = [{k: np.exp(row[k] - row.max()) for k in chosen} for row in ll]
        for _ in range(langid.ROUNDS):
            sums = dict.fromkeys(chosen, 0.0)
            for p in like:
                total = max(sum(p[k] * pi[k] for k in chosen), 1e-300)
                for k in chosen:
                    sums[k] += p[k] * pi[k] / total
            pi = {k: v / len(segments) for k, v in sums.items()}
        return pi, sum(np.log(max(sum(p[k] * pi[k] for k in chosen), 1e-300)) + row.max() for p, row in zip(like, ll, strict=True))

    best = int(ll.sum(0).argmax())
    full, _ = fit(range(len(model.languages)))
    order = sorted(range(len(model.languages)), key=lambda k: (k != best, -full[k], k))
    pi, score = {best: 1.0}, ll[:, best].sum()
    for m in range(2, len(order) + 1):
        got, value = fit(order[:m])
        if value - langid.PENALTY * np.log1p(len(segments)) <= score:
            break
        pi, score = got, value - langid.PENALTY * np.log1p(len(segments))
    top = min(pi, key=lambda k: (-pi[k], k))
    return model.languages[top], pi[top]


def test_language_mixtures_match_plain_em(spark):
    docs = table(spark, DATA, "documents").filter("text IS NOT NULL")
    model = langid.train(docs)
    some = [r.text for r in docs.filter("length(text) < 3000").orderBy("doc_id").limit(40).collect()]
    mixed = [a + " " + b for a, b in zip(some, some[7:], strict=False)]
    texts = [*some, *mixed, "", "123 456", None, "x"]
    pred, score, shares = model.predict(texts)
    want = [plain_mixture(model, t or "") for t in texts]
    assert pred == [w for w, _ in want] and np.allclose(score, [v for _, v in want], atol=1e-4)
    assert (shares > 0.05).sum(1).max() > 1  # some are mixtures


def test_long_texts_in_pieces(spark, monkeypatch):
    docs = table(spark, DATA, "documents").filter("text IS NOT NULL")
    model = langid.train(docs)
    text = " ".join(r.text for r in docs.filter("lang = 'en'").orderBy("doc_id").limit(20).collect())
    whole = model.predict([text, "abc"])
    monkeypatch.setattr(langid, "PIECE", 700)
    parts = list(langid.pieces([text, None, "abc"]))
    assert "".join(p for owner, ps in parts for o, p in zip(owner, ps, strict=True) if o == 0) == text
    cut = model.predict([text, "abc"])
    assert cut[0] == whole[0] and abs(cut[1][0] - whole[1][0]) < 0.05 and cut[1][1] == whole[1][1]


def test_language_odd_rows(spark):
    d = spark.createDataFrame([(1, "a b c", "en", 0.5), (None, "d e f", "de", 0.5), (3, None, None, 0.5)], "doc_id long, text string, lang string, score double")
    got = langid.predict_all(d).collect()
    assert len(got) == 3 and all(r.held_out is not None for r in got)
    with pytest.raises(ValueError, match="score"):
        langid.identify(d, langid.train(d))
    assert langid.predict_all(d.limit(0)).count() == 0 and langid.keep_identified(d.limit(0), 0.3).count() == 0
    with pytest.raises(ValueError, match="already"):
        bpe.encode(d, BPE, ids="score")


def test_sources_of_long_numbers_and_weights_of_zero(spark):
    d = spark.createDataFrame([(1, "a b", "en", "src1234567892"), (2, "a b", "en", "s7x9"), (3, "a b c", "de", "s3"), (4, "a", None, None)], "doc_id long, text string, lang string, source string")
    assert {r.doc_id: r.domain for r in mixing.mixture(d).collect()} == {1: "d0", 2: "d3", 3: "d3", 4: "none"}
    got = {r.doc_id: (r.leaf_budget, r.copies) for r in mixing.mixture(d, mixing.Mixture(lang={"de": 0}, percent=100, epochs=1)).collect()}
    assert got[3] == (0, 0) and got[1] == (2, 1) and sum(b for b, _ in got.values()) == 5
    kept = mixing.select(d.withColumn("copies", F.lit(1)), mixing.Mixture(lang={"de": 0}, percent=100, epochs=1))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4] and kept.columns == [*d.columns, "copies"]


def plain_select(docs, mix):
    """Ids that hierarchical budgeting uses at least once, by filling children one at a time."""
    tokens = lambda r: len([w for w in re.split(r"[\x20\x09-\x0D]+", r.text or "") if w])
    leaf_of = lambda r: (("d" + str(int(m[0]) % 4)) if (m := re.search(r"\d+", r.source or "none")) else "none", r.lang or "none", r.source or "none")
    total = defaultdict(int)
    for r in docs:
        total[leaf_of(r)] += tokens(r)
    weight = lambda level, name: getattr(mix, level).get(name, mix.other)
    budget = {(): sum(total.values()) * mix.percent // 100}
    for n, level in enumerate(mixing.LEVELS):
        supply = defaultdict(int)
        for k, v in total.items():
            supply[k[: n + 1]] += v * mix.epochs
        nxt = {}
        for parent, money in budget.items():
            open_ = {k for k in supply if k[:n] == parent}
            while True:
                rest, weights = money - sum(nxt.get(k, 0) for k in supply if k[:n] == parent), sum(weight(level, k[n]) for k in open_)
                full = {k for k in open_ if supply[k] * weights <= rest * weight(level, k[n])}
                if not full:
                    break
                nxt |= {k: supply[k] for k in full}
                open_ -= full
            nxt |= {k: rest * weight(level, k[n]) // weights for k in open_}
        budget = nxt
    out = set()
    for leaf, money in budget.items():
        mine = [r for r in docs if leaf_of(r) == leaf]
        whole, rest = divmod(money, total[leaf]) if total[leaf] else (0, 0)
        so_far, ordered = 0, defaultdict(list)
        for r in mine:
            ordered[md5(f"{mix.seed}:{whole}:{'null' if r.doc_id is None else r.doc_id}".encode()).hexdigest()].append(r)
        for k in sorted(ordered):
            so_far += sum(map(tokens, ordered[k]))
            if whole or so_far <= rest:
                out |= {r.doc_id for r in ordered[k]}
    return out


def test_pipeline_matches_brute_force(spark, library):
    import corpus_pipeline as cp

    docs = table(spark, "/root/testdata/sf0.01", "documents").filter("length(text) < 4000")
    extra = [(10**9, "привет мир это русский текст для проверки " * 5, None, "src1", 0), (10**9 + 1, None, None, None, 0), (10**9 + 2, "99 88 77", None, "src2", 0)]
    docs = Workspace(spark).keep(docs.union(spark.createDataFrame(extra, docs.schema)))
    model = langid.train(docs)
    one = Workspace(spark).keep(cp.STAGES[0][1](spark, docs, DATA))
    rows_ = docs.collect()
    fits = model.judge([r.text for r in rows_])[3]
    told = {r.doc_id: (*plain_mixture(model, r.text or ""), f, r.lang) for r, f in zip(rows_, fits.tolist(), strict=True)}
    want = {i: known or lang for i, (lang, share, f, known) in told.items() if lang != "und" and share >= cp.LEAST_SHARE and f}
    assert {r.doc_id: r.lang for r in one.collect()} == want and not {10**9, 10**9 + 1, 10**9 + 2} & set(want)
    two = Workspace(spark).keep(cp.STAGES[1][1](spark, one, DATA))
    comp = brute_join((r.doc_id, r.text) for r in one.collect())
    assert sorted(r.doc_id for r in two.collect()) == sorted(i for i, (_, c) in comp.items() if c == i)
    three = Workspace(spark).keep(cp.STAGES[2][1](spark, two, DATA))
    assert {r.doc_id for r in three.collect()} == plain_select(two.collect(), cp.MIXTURE)
    last = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in cp.STAGES[3][1](spark, three, DATA).collect()}
    for r in three.collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert last[r.doc_id] == (len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256(r.text.encode()).hexdigest())
    assert one.columns == two.columns == three.columns == docs.columns


def test_pipeline_stages_on_odd_rows(spark, odd):
    import corpus_pipeline as cp

    docs = odd.select(F.col("doc_id"), F.col("text"), F.lit("en").alias("lang"), F.lit("src1").alias("source"), F.lit(1).cast("long").alias("n_chars"), F.lit(7).alias("component_id"))
    for d in (docs, docs.limit(0)):
        for _, stage in cp.STAGES[:-1]:
            out = stage(spark, d, DATA)
            assert out.columns == d.columns and out.count() <= d.count()
        assert cp.STAGES[-1][1](spark, d, DATA).count() == d.count()


def test_pipeline_stages_chain(spark):
    import corpus_pipeline

    docs = table(spark, DATA, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == columns, name
        docs = Workspace(spark).keep(out)
        if name == "ngram_jaccard_join":
            comp = brute_join((r.doc_id, r.text) for r in docs.collect())
            assert all(c == i for i, (_, c) in comp.items())
    last = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert last.count() == docs.count() > 0


def test_workers_let_go_of_what_another_operator_kept(spark, monkeypatch):
    d, tasks = table(spark, DATA, "documents").limit(20), []
    real = type(d).mapInArrow
    monkeypatch.setattr(type(d), "mapInArrow", lambda self, f, schema: tasks.append(f) or real(self, f, schema))
    coded, told = bpe.digests(d, BPE), jaccard.profile(d, "doc_id", "text", 5)
    batches = lambda: iter(d.select("doc_id", "text").toArrow().to_batches())
    assert sum(b.num_rows for b in tasks[0](batches())) == 20 and bpe._encoders and coded.count() == 20
    again = bpe.encoder(BPE)
    assert list(tasks[0](batches())) and bpe.encoder(BPE) is again  # its own next task still has it
    assert list(tasks[1](batches())) and not bpe._encoders and jaccard._powers and told.filter("slice IS NULL").count() == 20
    assert list(tasks[0](batches())) and bpe._encoders and not jaccard._powers
