"""URL filters, hard negatives and phrases against brute force on small frames with every odd case."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import negatives, phrases, queries, urls

CLASH = ("rule", "verdict", "host", "trust", "kind", "src", "n", "bucket", "cut", "label_", "anchor_id", "score", "least", "shard", "phrase", "length", "f", "reach", "rank")


def clashing(df):
    return df.withColumns({c: F.lit(1) for c in CLASH if c not in df.columns})


def rows_of(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def oracle(name, **tables):
    con = duckdb.connect()
    for t, frame in tables.items():
        con.register(t, frame.toArrow())
    return con.execute(queries.ORACLE_SQL[name])


# URL filters ------------------------------------------------------------------------------------------------------


def page(k, url, *links):
    return (k, url, "".join(f'<a  href = "{x}">x</a>' for x in links) if links else None)


@pytest.fixture(scope="module")
def pages(spark):
    good = [page(k, f"https://www.good.example.org/fr/{k}", "https://friend.info/x", "//Second.Example.org/?a") for k in range(3)]
    bad = [page(10 + k, f"http://bad.example.com/de/{k}#x") for k in range(3)]
    rest = [
        page(20, "https://friend.info/about", "https://third.info:80/", "http://bad.example.com"), page(21, "http://Links-To-Bad.info", "http://bad.example.com/de/9", "http://bad.example.com/", "/local", "http://links-to-bad.info/own"),
        page(22, "https://far.info/?q", "http://LINKS-to-bad.info"), page(23, "https://alone.info/a"), page(24, None), page(25, "no scheme/net/"), page(26, "://x.net/en"), page(27, "http://example.net/en/1"), page(28, "http://a.example.net/en"),
        page(29, "http://net"), page(30, "http://notnet/x"), page(31, "http://user@b.net:8/y"), page(32, "ftp://example.com/de/x?y#z"), page(33, "http://bad.example.com/en/"), page(34, "http://x.org/fr/"), page(35, "http://x.org/fr"), page(36, "http://é.org/fr/é/"),
        page(37, "a://b://c.net/d"), page(23, "https://alone.info/a"), (None, "http://y.net/", ""), page(38, "http://good.example.org/de/", *["https://friend.info/x"] * 3),
        (39, "http://odd.info/", "<a href='https://one.info'><A HREF=//two.info/><a href=\n'http:\\\\three'><a data-href='x://four.info?'><a href='mailto:x@y'><a href='" + "z" * 1000),
    ]
    return clashing(spark.createDataFrame(good + bad + rest, "page_id long, url string, html string")).repartition(3)


def walk_ranks(seeds, links):
    """Sum of the masses of all walks of up to WALK links from the seeds."""
    out = defaultdict(float)
    x = {h: 1 - urls.DAMPING for h in seeds}
    for _ in range(urls.WALK + 1):
        nxt = defaultdict(float)
        for h, m in x.items():
            out[h] += m
            here = links.get(h, {})
            for to, n in here.items():
                nxt[to] += urls.DAMPING * m * n / sum(here.values())
        x = nxt
    return out


def test_url_filter(pages):
    got = urls.judge(pages)
    host, path = (lambda u: (re.search("://([^/?#]*)", u) or [0, ""])[1]), (lambda u: (re.search("://[^/?#]*([^?#]*)", u) or [0, ""])[1])
    low = str.maketrans(urls.UPPER, urls.LOWER)
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    forward, backward, count, want = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), []
    plain = pages.select("page_id", "url", "html").collect()
    for r in plain:
        h, p = host(r.url or "").translate(low), path(r.url or "")
        fits = [x for x in rules if ("." + h).endswith("." + x.split("/")[0]) and p.startswith(x[x.index("/") :])]
        rule = max(fits, key=len, default=None)
        count[h][rules.get(rule)] += 1
        want.append((r.page_id, h, p, rule))
        for to in {x.translate(low) for x in re.findall(urls.LINK, r.html or "")} - {h} if h else ():
            forward[h][to] += 1
            backward[to][h] += 1
    seeds = {v: [h for h, c in count.items() if h and 2 * c[v] > sum(c.values())] for v in ("allow", "block")}
    trust, distrust = walk_ranks(seeds["allow"], forward), walk_ranks(seeds["block"], backward)
    blocked = {h for h in {w[1] for w in want} if round(distrust[h], 12) >= urls.THRESHOLD and round(distrust[h], 12) > round(trust[h], 12)}
    want = [(*w, rules.get(w[3]) or ("block" if w[1] in blocked else "allow")) for w in want]
    assert rows_of(got, "page_id", "host", "path", "rule", "verdict") == sorted(want, key=str)
    by_id = {r.page_id: r for r in got.collect()}
    assert {by_id[k].verdict for k in (21, 22, 33)} == {"block"} and {by_id[k].verdict for k in (20, 23, 24, 25, 29, 30)} == {"allow"}
    assert by_id[20].trust == by_id[20].distrust > urls.THRESHOLD and by_id[28].rule == "net/" and by_id[27].rule == "example.net/en/"
    assert {"one.info", "two.info", "four.info"} <= forward["odd.info"].keys() and not any("three" in x for x in forward["odd.info"])
    cur = oracle("op11_url_filter", pages=pages.select("page_id", "url", "html"))
    assert [d[0] for d in cur.description] == ["page_id", "host", "path", "rule", "verdict"] and sorted(cur.fetchall(), key=str) == sorted(want, key=str)


def test_url_filter_edges(spark, pages):
    assert urls.judge(pages.limit(0)).count() == 0
    assert {r.verdict for r in urls.judge(pages, rules=()).collect()} == {"allow"}
    hot = spark.range(400).select(F.col("id").alias("page_id"), F.lit("http://hub.info/").alias("url"), F.concat(F.lit("<a href='http://h"), F.col("id") % 97, F.lit(".info/'>"), F.repeat(F.lit("<p>text</p>"), 1000)).alias("html"))
    found = {(r.src, r.dst): r.n for r in urls.host_links(hot.withColumn("host", F.lit("hub.info"))).collect()}
    assert len(found) == 97 and sum(found.values()) == 400
    ranked = urls.ranked([("allow", "a.net/x"), ("block", "a.net/x"), ("block", "net/"), ("allow", "b.a.net")])
    assert [(r[0], r[1]) for r in ranked] == [("allow", "b.a.net"), ("block", "a.net/x"), ("allow", "a.net/x"), ("block", "net/")]


# hard negatives ---------------------------------------------------------------------------------------------------


def plain_negatives(rows, positives=5, negatives_=10):
    """By the definition, in whole numbers."""
    kept = {}
    for vec_id, vec, label in rows:
        if None in (vec_id, vec, label) or any(v is None or not np.isfinite(v) for v in vec):
            continue
        entry = (label, [float(v) for v in vec])
        kept[vec_id] = min(kept.get(vec_id, entry), entry)
    x = {k: [negatives.whole_number(v) for v in e[1]] for k, e in kept.items()}
    out = []
    for a in kept:
        if a % 100:
            continue
        score = {k: sum(p * q for p, q in zip(x[a], v)) for k, v in x.items() if k != a}
        near = sorted((k for k in score if kept[k][0] == kept[a][0]), key=lambda k: (-score[k], k))[:positives]
        for p in near:
            fits = sorted((k for k in score if kept[k][0] != kept[a][0] and 30 * score[p] <= 100 * score[k] <= 90 * score[p]), key=lambda k: (-score[k], k))
            out += [(a, p, n + 1, k, score[p], score[k]) for n, k in enumerate(fits[:negatives_])]
    return sorted(out, key=str)


COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def vectors(spark, rows):
    return clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).repartition(3)


def test_negatives_against_plain(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 12))
    rows = [(k, [float(v) for v in (centres[k % 5] + rng.normal(size=12)) * rng.choice([0.02, 0.5, 1, 6])], int(k % 4)) for k in range(700)]
    rows += [(700, None, 1), (800, [0.0] * 12, 2), (801, [0.0] * 12, 3), (900, [1.0] * 12, None), (901, [float("nan")] * 12, 1), (902, [1.0, None] * 6, 1), (1000, [float("inf")] * 12, 1), (None, [1.0] * 12, 1), (1100, [], 1), (1200, [1.0, 2.0], 1), (1300, [0.5] * 12, 77)]
    rows += [rows[5], rows[100], (100, [9.0] * 12, 3)]  # repeated rows, and a vec_id with two vectors
    rows += [(2000 + k, [float(v) for v in centres[0]], k % 2) for k in range(150)]  # one vector many times: ties
    data = vectors(spark, rows)
    want = plain_negatives(rows)
    assert len(want) > 200
    assert rows_of(negatives.hard_negatives(data, F.col("vec_id") % 100 == 0), *COLUMNS) == want
    monkeypatch.setattr(negatives, "TILE_VALUES", 12 * 40)  # many tiles, several blocks of anchors, a trial in each tile
    monkeypatch.setattr(negatives, "ANCHOR_ROWS", 3)
    monkeypatch.setattr(negatives, "TRIAL", 8)
    assert rows_of(negatives.hard_negatives(data, F.col("vec_id") % 100 == 0), *COLUMNS) == want


def test_negatives_edges(spark):
    assert negatives.hard_negatives(vectors(spark, []), F.col("vec_id") % 100 == 0).count() == 0
    assert negatives.hard_negatives(vectors(spark, [(0, [1.0], 1), (1, [1.0], 2)]), F.col("vec_id") % 100 == 0).count() == 0  # no positives
    huge = [(0, [1e12, 1.0], 1), (1, [1e12, 3.0], 1), (2, [5e11, 7.0], 2), (3, [8.9e11, 7.0], 3), (4, [-1e300, 1.0], 1), (5, [1e300, 1.0], 2)]
    got = rows_of(negatives.hard_negatives(vectors(spark, huge), F.col("vec_id") % 100 == 0), *COLUMNS)
    top = (1 << 63) - 1
    assert got == [] or all(abs(r[5]) <= top for r in got)
    exact = [(0, [2.0**22, 1.0], 1), (1, [2.0**22, 3.0], 1), (2, [2.0**21, 7.0], 2), (3, [2.0**21, 7.5], 3), (4, [-(2.0**22), 1.0], 2)]
    assert rows_of(negatives.hard_negatives(vectors(spark, exact), F.col("vec_id") % 100 == 0), *COLUMNS) == plain_negatives(exact)


def test_lists_prune_and_keep_all(spark):
    """Of rows that can reach the threshold none is lost, and most others never meet the exact product."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 16)) * 3
    x = centres[rng.integers(0, 40, 2000)] + rng.normal(size=(2000, 16)) * 0.4
    x = x / np.linalg.norm(x, axis=1)[:, None] * rng.uniform(1, 1.2, 2000)[:, None]
    import pandas as pd

    tile = negatives.Tile(pd.DataFrame({"vec_id": np.arange(2000), "label": 0, "vec": list(x)}))
    seen = 0
    for q in x[:60]:
        s = tile.scores(q, np.arange(2000))
        for least, most in ((int(np.sort(s)[-10]), np.inf), (int(0.3 * s.max()), int(0.9 * s.max())), (-(10**5), 0)):
            at = tile.feasible(q, float(least), float(most))
            assert set(np.flatnonzero((s >= least) & (s <= most))) <= set(at.tolist())
        seen += len(tile.feasible(q, float(np.sort(s)[-10])))
    assert seen < 0.5 * 60 * 2000


# phrases ----------------------------------------------------------------------------------------------------------


def plain_phrases(docs, least=10, longest=3, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(str.maketrans(urls.UPPER, urls.LOWER))):
            w = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang or "und"][tuple(w[i : i + k])] += 1
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        keep = []
        for p, a in cand.items():
            if any(100 * b >= 50 * a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in cand.items()):
                continue
            score, k = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            keep.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(keep)[:top])]
    return sorted(out, key=str)


PHRASE_COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@pytest.fixture(scope="module")
def prose(spark):
    rng = random.Random(5)
    kinds = [f"w{k}" for k in range(60)] + ["É", "Straße", "\u00a0x", "\x00", "a\x1cb", "tab\tbed"]
    docs = [(k, rng.choice(["en", "de", None, "und"]), " ".join(rng.choices(kinds, weights=[1 / (i + 1) for i in range(len(kinds))], k=rng.randrange(90))).replace("w3 ", rng.choice(["w3. ", "w3,", "w3\n", "W3  ", "w3 "]))) for k in range(160)]
    docs += [(500, "en", None), (501, "en", ""), (502, "fr", "New York. " * 9), (503, "fr", "new york"), (504, "fr", "x y z " * 400), (505, "es", "a a a a a a a a a a a a"), (506, None, "\t.. , "), (506, None, "late pair " * 12), (None, "en", "late pair " * 12)]
    return docs


@pytest.mark.parametrize(("longest", "shards", "slots", "exact"), [(3, 3, 1 << 12, 0), (4, 2, 1, 0), (4, 2, 1, 1 << 20)])
def test_phrases_against_plain(spark, prose, longest, shards, slots, exact, monkeypatch):
    """With the exact table of steps, with slots, and with a single slot for all."""
    monkeypatch.setattr(phrases, "EXACT_ROWS", exact)
    docs = clashing(spark.createDataFrame(prose, "doc_id long, lang string, text string")).repartition(4)
    want = plain_phrases([d[1:] for d in prose], longest=longest)
    assert len(want) > 50
    assert rows_of(phrases.collocations(docs, longest=longest, shards=shards, slots=slots), *PHRASE_COLUMNS) == want
    if longest == 3:
        cur = oracle("op13_phrase_mining", documents=docs.select("doc_id", "lang", "text"))
        at = [[d[0] for d in cur.description].index(c) for c in PHRASE_COLUMNS]
        assert sorted((tuple(r[i] for i in at) for r in cur.fetchall()), key=str) == want


def test_phrases_activation(spark, prose):
    """A phrase has a count only if both its parts have become frequent; that count is over every document."""
    docs = spark.createDataFrame(prose, "doc_id long, lang string, text string")
    counts, words = phrases.phrase_counts(docs, slots=1 << 12)
    found = {(r.lang, r.phrase): r.f for r in counts.collect()}
    for lang, phrase in found:
        w = phrase.split(" ")
        if len(w) > 1:
            assert found[lang, " ".join(w[:-1])] >= 10 <= found[lang, " ".join(w[1:])]
    assert min(found.values()) >= 10 and found["fr", "new york"] == 10 and {r.lang for r in words.collect()} == {"en", "de", "und", "fr", "es"}


def test_phrase_hashes_are_those_of_spark(spark):
    rows = [(k, -(k**5) - 3) for k in range(50)]
    x = np.array(rows, np.int64).view(np.uint64)
    want = [r.h for r in spark.createDataFrame(rows, "a long, b long").coalesce(1).select(F.xxhash64("a", "b").alias("h")).collect()]
    assert phrases.joined(x[:, 0].copy(), x[:, 1].copy()).view(np.int64).tolist() == want


def test_phrases_edges(spark, monkeypatch):
    schema = "doc_id long, lang string, text string"
    assert phrases.collocations(spark.createDataFrame([], schema), slots=16).count() == 0
    assert phrases.collocations(spark.createDataFrame([(1, "en", None), (2, None, "rare words here")], schema), slots=16).count() == 0
    monkeypatch.setattr(phrases, "PART", 64)  # long texts in many parts
    monkeypatch.setattr(phrases, "CHUNK_WORDS", 50)
    monkeypatch.setattr(phrases, "KNOWN_WORDS", 20)
    docs = [(1, "en", "lorem ipsum dolor " * 400), (2, "en", "x" * 1000 + " lorem ipsum. Dolor\tsit amet " * 30), (3, "de", "eins zwei " * 50)]
    got = phrases.collocations(spark.createDataFrame(docs, schema), slots=16)
    assert rows_of(got, *PHRASE_COLUMNS) == plain_phrases([d[1:] for d in docs])


def test_phrases_split_texts_once(spark, monkeypatch):
    """Every scan reads numbered words, not texts; rows with numbers of two and of four bytes, and short rows, give the plain result."""
    monkeypatch.setattr(phrases, "ROW_WORDS", 40)
    monkeypatch.setattr(phrases, "NARROW", 8)
    seen, scan = [], phrases.scan
    monkeypatch.setattr(phrases, "scan", lambda shard, *a: seen.append(shard.columns) or scan(shard, *a))
    rng = random.Random(3)
    docs = [(k, rng.choice(["en", "a.b. c", None]), " ".join(rng.choices(["x", "y.", "É", "z"] if k % 2 else [f"w{i}" for i in range(12)], k=30))) for k in range(120)]
    docs += [(200, "long", "p q r " * 50), (201, "void", ". ."), (202, "void", None)]
    got = phrases.collocations(spark.createDataFrame(docs, "doc_id long, lang string, text string"))
    assert rows_of(got, *PHRASE_COLUMNS) == plain_phrases([d[1:] for d in docs])
    assert len(seen) > 2 and all("text" not in columns and "ids" in columns for columns in seen)


def test_numbered_words_are_those_of_the_texts(spark, monkeypatch):
    monkeypatch.setattr(phrases, "ROW_WORDS", 6)
    monkeypatch.setattr(phrases, "NARROW", 5)
    docs = [("en", "One two. two\tONE", 0), ("en", "", 0), ("de", "a b c d e f g a", 1), ("en", "three  two!", 1), ("en", " .. ", 0), ("en", "six six six six six six six", 0), ("en", "end", 0)]
    rows = spark.createDataFrame(docs, "lang string, text string, shard int").coalesce(1).withColumn("text", F.col("text").cast("binary"))
    got = defaultdict(list)
    for r in phrases.numbered(rows).collect():
        words = bytes(r.words).split(b" ") if r.words else []
        ids = np.frombuffer(bytes(r.ids), "<u2" if len(words) < 5 else "<u4")
        assert len(set(words)) == len(words)
        got[r.lang, r.shard].append([words[i - 1].decode() if i else "." for i in ids.tolist()])
    assert sum(got["en", 0], []) == ["one", "two", ".", "two", "one", ".", ".", ".", ".", ".", *["six"] * 7, ".", "end", "."]
    assert got["en", 1] == [["three", "two", ".", "."]] and got["de", 1] == [[*"abcdefga", "."]]


def test_word_hashes_are_those_of_spark(spark):
    words = phrases.Words("fr")
    known = ["a", "été", "straße", "x" * 40]
    assert [words[w.encode()] for w in known] == [0, 1, 2, 3]
    h = words.hashes()
    table = [*(("fr", w, 1) for w in known), ("fr", "a été", 2), ("fr", "a été straße", 3)]
    got = [r.h for r in spark.createDataFrame(table, "lang string, phrase string, length int").coalesce(1).select(phrases.hash_of(3).alias("h")).collect()]
    pair = phrases.joined(h[:2], h[1:3])
    assert np.array(got, np.int64).view(np.uint64).tolist() == [*h.tolist(), int(pair[0]), int(phrases.joined(pair[:1], pair[1:])[0])]
