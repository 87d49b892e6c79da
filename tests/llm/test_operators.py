"""Each operator against a plain version of its contract, and on edge cases."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from quadmill.llm import common, exact_dedup, language_model, main_text, mixing, packing, quality_model, repetition, secrets, simhash, url_filter

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def docs(spark):
    """Documents, with nulls, empty, long and repeated texts, and clashing extra columns."""
    own = pd.read_parquet(f"{SF}/documents.parquet")[["doc_id", "text", "lang", "source", "n_chars"]]
    odd = [
        (10**6, None, None, None, None), (10**6 + 1, "", "en", "src0", 0), (10**6 + 2, " \n\t", "en", "src0", 3), (10**6 + 3, "a b c " * 20000, "en", "src1", 120000),
        (10**6 + 4, "a  b\tc " * 20000, "en", "src1", 140000), (10**6 + 5, "x" * 50000, "en", "src2", 50000), (10**6 + 6, "é\U0001f600 password = abcdefgh12 \x00<|endoftext|>", "en", "src0", 9),
    ]
    known = [tuple(v.item() if hasattr(v, "item") else v for v in r) for r in own.itertuples(index=False)]
    df = spark.createDataFrame(known + odd, DOCS)
    return df.select("*", *[F.lit(1).alias(c) for c in ("node", "length", "digest", "fp", "body", "score", "copy", "count", "word")]).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{SF}/pages.parquet")


def texts(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def low(text):
    return text.encode().lower().decode()


def rows(df):
    return [r.asDict() for r in df.collect()]


# Packing ----------------------------------------------------------------------------


def test_packing(docs):
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(packing.public_files().json)
    got = packing.pack(docs).toPandas()
    by = {k: g.sort_values("piece") for k, g in got.groupby("doc_id")}
    total = 0
    for doc_id, text in texts(docs):
        ids = np.array([*slow.encode(text, add_special_tokens=False).ids, 2], "<u4")
        total += len(ids)
        g = by[doc_id]
        assert list(g.piece) == list(range(len(g))) and g.length.sum() == len(ids)
        assert list(g.start) == [0, *np.cumsum(g.length)[:-1]] and all(g.length[1:] == 1024) and g.length.max() <= 1024
        assert all(zlib.crc32(ids[s : s + n].tobytes()) == c for s, n, c in zip(g.start, g.length, g.ids_crc32))
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert list(g.offset) == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() <= 1024
    assert got.sequence_id.nunique() <= math.ceil(total / 1024) * 1.02 + 1


@pytest.mark.parametrize("select", ["norm", "dot"])
def test_packing_keeps_every_capacity(select):
    rng = np.random.default_rng(1)
    counts = Counter(rng.integers(1, 60, 3000).tolist())
    cap = packing.Capacities(tokens=100, documents=4, attention=4000, select=select)
    places, opened = packing.plan(counts, cap)
    bins = defaultdict(list)
    for n, c in counts.items():
        mine = places[places[:, 0] == n]
        for rank in range(c):
            row = mine[np.searchsorted(mine[np.argsort(mine[:, 1]), 1], rank, side="right") - 1] if (np.diff(mine[:, 1]) > 0).all() else None
            assert row is not None
            bins[row[3] + (rank - row[1]) // row[2]].append((row[4] + (rank - row[1]) % row[2] * n, n))
    assert len(bins) == opened
    for members in bins.values():
        members.sort()
        assert [m[0] for m in members] == [0, *np.cumsum([m[1] for m in members])[:-1]]
        assert sum(m[1] for m in members) <= 100 and len(members) <= 4 and sum(m[1] ** 2 for m in members) <= 4000


# SimHash ---------------------------------------------------------------------------


def plain_fingerprint(text, k=3):
    words = WORDS.findall(low(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash(docs):
    fps = {d: plain_fingerprint(t) for d, t in texts(docs) if len(t) < 60000}
    got = {r["doc_id"]: r for r in rows(simhash.classify(docs)) if r["doc_id"] in fps}
    assert {d: r["fingerprint"] for d, r in got.items()} == {d: f"{f:016x}" for d, f in fps.items()}
    ids = list(fps)
    want = components(ids, [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (fps[a] ^ fps[b]).bit_count() <= 2])
    assert {d: r["component_id"] for d, r in got.items()} == want


@pytest.mark.parametrize("bands", [None, 4, 5])
def test_pivot_links_are_exact(spark, bands):
    """Random fingerprints around a few centres, with cells above CELL_ROWS."""
    rng = np.random.default_rng(5)
    fps = set()
    for centre in rng.integers(0, 1 << 63, 6).tolist():
        for _ in range(150):
            f = centre
            for b in rng.choice(64, rng.integers(0, 5), replace=False):
                f ^= 1 << int(b)
            fps.add(f)
    fps = sorted(fps)
    got = simhash.links(spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp bigint"), bands).collect()
    links = {(r.src & (1 << 64) - 1, r.dst & (1 << 64) - 1) for r in got}
    assert all((a ^ b).bit_count() <= 2 for a, b in links)
    want = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= 2]
    assert components(fps, links) == components(fps, want)


def test_similar_texts_are_dropped(spark):
    rng = np.random.default_rng(6)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    base = [[word() for _ in range(300)] for _ in range(20)]
    data = [(k, " ".join(w)) for k, w in enumerate(base)]
    for k, w in enumerate(base):
        w = list(w)
        w[int(rng.integers(300))] = "changed"
        data.append((100 + k, " ".join(w)))
        data.append((200 + k, " ".join(w[150:] + [word() for _ in range(150)])))
    data.append((3, data[3][1]))
    kept = [r.doc_id for r in simhash.similar_dedup(spark.createDataFrame(data, "doc_id bigint, text string")).collect()]
    assert sorted(kept) == [*range(20), *range(200, 220)]


def near_kept(data):
    """Who stays of (doc_id, text), by comparing all pairs."""
    sets = {d: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for d, w in ((d, t.split()) for d, t in data)}
    ids = list(sets)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9]
    return sorted(set(components(ids, pairs).values()))


def test_near_copies_of_any_kind_are_dropped(spark):
    """Short texts with an edit at each place, pairs whose segments are all frequent, and
    long pairs about the limit, against all pairs."""
    rng = np.random.default_rng(9)
    some = lambda n: ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(n)]
    data = []
    for size in (10, 20, 35):
        for at in range(size):
            w = some(size)
            data += [w, w[:at] + ["changed"] + w[at + 1 :]]
    passages = [some(40) for _ in range(12)]
    for _ in range(60):
        own = [passages[i] for i in rng.choice(12, 6, replace=False)]
        data += [sum(own, []), sum(own, []) + some(9)]
    for k in range(24):
        w = some(900)
        at = (np.arange(14 + k) * 900 // (14 + k)).tolist()
        data += [w, [f"new{k}" if i in at else x for i, x in enumerate(w)]]
    data = [(k, " ".join(w)) for k, w in enumerate(data)]
    kept = [r.doc_id for r in simhash.similar_dedup(spark.createDataFrame(data, "doc_id bigint, text string")).collect()]
    assert sorted(kept) == near_kept(data)


def test_components_contracted_and_by_stars_agree(spark, monkeypatch):
    """In one part, in several, and native; with a hot node, a long path and loops."""
    rng = np.random.default_rng(3)
    edges = [(0, k) for k in range(1, 400)] + [(k, k + 1) for k in range(1000, 1100)] + [(5000, 5000)] + rng.integers(2000, 2600, (400, 2)).tolist()
    df = spark.createDataFrame([(int(a), int(b)) for a, b in edges], "src bigint, dst bigint")
    want = components({n for a, b in edges for n in (a, b) if a != b}, [(a, b) for a, b in edges if a != b])
    for chunk, native in ((1 << 19, False), (100, False), (1 << 19, True)):
        monkeypatch.setattr(common, "CHUNK_EDGES", chunk)
        got = common.connected_components(df, native=native).collect()
        assert {r.node: r.component for r in got} == want and len(got) == len(want)


def test_hot_nodes_are_split(spark):
    """The joins of a star step meet nothing but scans, so that skewed partitions are split."""
    conf = {"autoBroadcastJoinThreshold": "-1", "adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "adaptive.advisoryPartitionSizeInBytes": "8k", "adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(f"spark.sql.{k}") for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(f"spark.sql.{k}", v)
        spark.range(1, 60_001).selectExpr("0L as src", "id as dst").repartition(16).write.mode("overwrite").parquet(path := common.table_path(spark, "star"))
        both = spark.read.parquet(path)
        both = both.union(both.select("dst", "src"))
        lowest = common.stored(both.groupBy(F.col("src").alias("n")).agg(F.min("dst").alias("low")), "lowest")
        joined = both.join(lowest, both["src"] == lowest["n"])
        joined.count()
        rows = joined.select("dst", "low")
        rows.write.format("noop").mode("overwrite").save()
        plan = joined._jdf.queryExecution()
        joined.collect()
        assert "isSkew" in plan.executedPlan().toString() or "skew=true" in plan.executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(f"spark.sql.{k}", v)


def test_long_texts_are_cut_and_whole_again(spark, monkeypatch):
    monkeypatch.setattr(common, "PIECE", 7)
    texts_in = [(0, None), (1, ""), (2, "a" * 7), (3, "é\U0001f600\n" * 20), (4, "b" * 8)]
    pieces = common.text_pieces(spark.createDataFrame(texts_in, "doc_id bigint, text string"))
    assert pieces.agg(F.max(F.length("_qm_part"))).first()[0] == 7
    back = pieces.mapInPandas(lambda it: (b[["doc_id", "_qm_text"]] for b in common.whole_texts(it)), "doc_id bigint, _qm_text string")
    assert sorted((r.doc_id, r._qm_text) for r in back.collect()) == [(d, t or "") for d, t in texts_in]


# Secrets ------------------------------------------------------------------------------


def plain_spans(text):
    out = []
    for k, r in enumerate(secrets.RULES):
        for m in re.finditer(r.regex, text):
            if len(m[r.group]) >= r.least:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_secrets(spark, docs):
    extra = ["AKIA" + "A1" * 9, "gh" + "p_" + "a" * 40, "token=passwd:abcdefgh", "éé API_KEY: 'abcd.efgh-ij'", "0123456789abcdef" * 3, "http://me:pw@host/", "-----BEGIN RSA PRIVATE KEY-----", "eyJa.eyJb.c"]
    df = spark.createDataFrame(list(enumerate(extra, 5_000_000)), "doc_id bigint, text string").unionByName(docs.select("doc_id", "text"))
    got = {r["doc_id"]: r for r in rows(secrets.report(df))}
    for doc_id, text in texts(df):
        spans = plain_spans(text)
        said = lambda s: ",".join(f"{secrets.RULES[k].kind}:{a}:{b}" for a, k, b in s)
        r = got[doc_id]
        assert r["spans"] == said(spans)
        base = [s for s in spans if s[1] < 3]
        assert r["base_sha256"] == hashlib.sha256(said(base).encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[1] == k for s in base) for k in range(3)]


def test_trigram_queries_hold_for_matches(docs):
    """No match lacks a trigram its query asks for, and postings agree with the bits."""
    samples = {"github": "ghp_" + "a" * 36, "slack": "xoxb-1234567890a", "google": "AIza" + "b" * 35, "stripe": "sk_live_" + "c" * 16, "jwt": "eyJa.eyJb.c", "pem": "-----BEGIN PRIVATE KEY-----", "login": "http://a:b@c", "assign": "Api_Key='12345678", "access": "AKIA" + "Z" * 12}
    for r in secrets.RULES:
        if r.kind in samples:
            have = secrets.trigrams(samples[r.kind].lower())
            assert re.search(r.regex, samples[r.kind])
            assert all(any(s <= have for s in clause) for clause in secrets.trigram_query(r.regex))
    posted = defaultdict(set)
    for r in secrets.postings(docs).collect():
        posted[r.trigram].add(r.doc_id)
    for t in ("key", "tok", "://"):
        assert posted[t] == {d for d, x in texts(docs) if t in x.lower()}


# Language model ------------------------------------------------------------------------


def test_language_model(docs):
    tokens = {d: [*WORDS.findall(low(t)), None] for d, t in texts(docs)}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d in tokens}
    count = Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    n, v = sum(count.values()), len(count)
    got = rows(language_model.score(docs))
    assert len(got) == len(tokens)
    for r in got:
        ws = tokens[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[r["doc_id"]], len(ws), n)
        assert r["n_known"] == sum(count[w] > 0 for w in ws)
        want = math.fsum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert math.isclose(r["base_score"], want, rel_tol=1e-9)
    gain = sum(r["score"] - r["base_score"] for r in got if r["held_out"])
    assert gain > 0


def test_language_model_counts_all_ngrams(spark, monkeypatch):
    """Scores of a model of all bigrams and trigrams, over words beyond any fixed head, in several chunks."""
    monkeypatch.setattr(language_model, "CHUNK", 500)
    rng = np.random.default_rng(8)
    data = [(None, "w1 w2 w3")]
    for k in range(60):
        at = rng.integers(0, 1500, 12)
        data.append((k, " ".join(f"w{a + i}" for a in at.tolist() for i in range(rng.integers(1, 6)))))
    data += [(100, ""), (101, "unseen words w1"), (102, "w5"), (103, "w7 " * 1000)]
    # Parts of one text each, so that chunks end between them.
    monkeypatch.setattr(language_model, "parts", lambda batch: (batch.iloc[i : i + 1] for i in range(len(batch))))
    chunks = language_model.make_chunks(spark.createDataFrame(data, "doc_id bigint, text string"))
    got = rows(language_model.score(spark.createDataFrame(data, "doc_id bigint, text string")))
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    seqs = [(d, [*t.split(), None]) for d, t in data]
    c = [Counter(), Counter(), Counter()]
    for d, ws in seqs:
        if not held(d):
            for k in range(3):
                c[k].update(tuple(ws[i : i + k + 1]) for i in range(len(ws) - k))
    n, v = sum(c[0].values()), len(c[0])
    types = [Counter(g[:-1] for g in x) for x in c]

    def p(gram):
        if len(gram) == 1:
            return (c[0][gram] + 0.5) / (n + 0.5 * (v + 1))
        seen = c[len(gram) - 2][gram[:-1]]
        low = p(gram[1:])
        return (max(c[len(gram) - 1][gram] - 0.75, 0) + 0.75 * types[len(gram) - 1][gram[:-1]] * low) / seen if seen else low

    assert chunks.count() > 1 and v > 512
    want = {d: math.fsum(math.log10(p(tuple(ws[max(0, i - 2) : i + 1]))) for i in range(len(ws))) for d, ws in seqs}
    assert len(got) == len(want)
    for r in got:
        assert math.isclose(r["score"], want[r["doc_id"]], rel_tol=1e-9)
    unseen = 0.5 / (n + 0.5 * (v + 1))
    for h in (("w7",), ("w7", "w7"), *list(types[2])[:5]):
        lost = math.prod(0.75 * types[len(h) - k][h[k:]] / c[len(h) - k - 1][h[k:]] for k in range(len(h)))
        assert math.isclose(math.fsum(p((*h, *w)) for w in c[0]) + lost * unseen, 1)


# URLs ------------------------------------------------------------------------------------


def test_url_classes(spark):
    link = lambda u: f'<html><head><LINK href="{u}" rel=canonical></head>'
    hop = lambda u: f"<meta http-equiv='Refresh' content='0; URL={u}'>"
    data = [
        (1, "http://a.org/x", hop("http://bad.net/q")), (2, "https://b.org/y", link("http://a.org/x")), (3, "http://c.org/z", ""), (4, "http://d.org/fr/1", link("http://bad.net/q")),
        (5, "http://e.org/p", link("http://f.example.net/en/2")), (6, "http://g.org/1", link("/2")), (7, "http://g.org/2#t", hop("//e2.net/")), (8, None, None), (9, "no scheme", link("http://bad.net/q")),
        (10, "http://X.Example.COM/de/a?b#c", None), (11, "http://net", ""), (12, "http://h.net/en/", ""), (12, "http://h.net/en/", ""),
    ]
    df = spark.createDataFrame(data, "page_id bigint, url string, html string").withColumn("host", F.lit("clash")).withColumn("node", F.lit(1))
    got = defaultdict(list)
    for r in url_filter.judge(df).collect():
        got[r.page_id].append((r.host, r.path, r.rule, r.verdict))
    one = {k: v[0] for k, v in got.items()}
    # 4 is allowed by its own rule, which makes the class of bad.net allowed where no rule decides
    assert one[1] == ("a.org", "/x", None, "allow") and one[4][2:] == ("org/fr/", "allow")
    assert one[5][3] == "allow" and one[6][3] == "block" and one[7][3] == "block" and one[3][3] == "allow"
    assert one[8] == ("", "", None, "allow") and one[9] == ("", "", None, "allow")
    assert one[10] == ("x.example.com", "/de/a", "example.com/de/", "block") and one[11][2] is None
    assert got[12] == [("h.net", "/en/", "net/", "block")] * 2
    con = duckdb.connect()
    pages = df.toPandas()  # noqa: F841
    want = sorted(con.sql(url_filter.judge_sql()).select("page_id, host, path, rule, verdict").fetchall(), key=str)
    assert want == sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df).collect()), key=str)


def test_url_relative_links(spark):
    link = lambda u: f'<link rel="canonical" href="{u}">'
    data = [
        (1, "http://a.org/b/c?d", link("e.html")), (2, "http://a.org/b/e.html", link("http://bad.net/")), (3, "http://a.org", link("f")), (4, "http://a.org/f#x", link("http://bad.net/")),
        (5, "http://a.org/g", link("?p=1")), (6, "http://a.org/g?p=1", link("http://bad.net/")), (7, "http://b.org/h", link("/go?to=http://bad.net/")), (8, "http://b.org/i", link("mailto:x@bad.net")), (9, "http://b.org/j", link("#k")),
    ]
    df = spark.createDataFrame(data, "page_id bigint, url string, html string")
    got = {r.page_id: r.verdict for r in url_filter.judge(df).collect()}
    assert got == {k: "block" if k < 7 else "allow" for k in range(1, 10)}
    con, pages = duckdb.connect(), df.toPandas()  # noqa: F841
    assert dict(con.sql(url_filter.judge_sql()).select("page_id, verdict").fetchall()) == got


def test_url_spellings_of_links(spark):
    """Dot segments, base addresses, references, root paths; no links from comments, scripts, titles."""
    link = lambda u: f'<link rel="canonical" href="{u}">'
    bad = link("http://bad.net/")
    data = [
        (1, "http://a.org/b/c/d", link("../e/./f?q=../g")), (2, "http://a.org/b/e/f?q=../g", bad), (3, "http://a.org/x/../b/e/f?q=../g", ""),
        (4, "http://b.org/b", '<base href="/deep/er/">' + link("../m")), (5, "http://b.org/deep/m", bad), (6, "http://b.org/m", ""),
        (7, "http://c.org", bad), (8, "http://c.org/", ""), (9, "http://c.org?x", ""),
        (10, "http://d.org/1", link("/2?a&#61;b&amp;c&#x3D;&#x1F600;")), (11, "http://d.org/2?a=b&c=\U0001f600", bad),
        (12, "http://e.org/1", f"<!-- {bad} --><SCRIPT>{bad}</script ><title>{bad}</title>"), (13, "http://e.org/2", f"<!-- open {bad}"),
        (14, "http://f.org/1", link("/2&#0;&#xD800;&#9999999;")), (15, "http://f.org/2" + "\ufffd" * 3, bad), (16, "http://g.org/1", link("../../../..")), (17, "http://g.org", bad),
        (18, "http://h.org/1", link("/2?x=&amp;amp;")), (19, "http://h.org/2?x=&amp;", bad), (20, "http://h.org/2?x=&", ""), (21, None, ""), (22, "http:///", bad), (23, "none", bad),
        (24, "http://i.org/1", '<base href="mailto:x@bad.net">' + link("2")), (25, "http://i.org/2", bad),
    ]
    df = spark.createDataFrame(data, "page_id bigint, url string, html string")
    got = {r.page_id: r.verdict for r in url_filter.judge(df).collect()}
    free = {6, 9, 12, 13, 20, 21, 23}
    assert got == {k: "allow" if k in free else "block" for k in range(1, 26)}
    con, pages = duckdb.connect(), df.toPandas()  # noqa: F841
    assert dict(con.sql(url_filter.judge_sql()).select("page_id, verdict").fetchall()) == got


def test_url_blocks_without_allow(spark):
    data = [(k, f"http://p{k}.org/", f'<link rel="canonical" href="http://p{k + 1}.org/">') for k in range(40)] + [(40, "http://p40.org/", '<link rel="canonical" href="http://z.net/">'), (41, "http://q.org/", "")]
    got = {r.page_id: r.verdict for r in url_filter.judge(spark.createDataFrame(data, "page_id bigint, url string, html string")).collect()}
    assert all(got[k] == "block" for k in range(41)) and got[41] == "allow"


# Rules and main text ---------------------------------------------------------------------


def test_repetition(docs):
    got = {r["doc_id"]: r for r in rows(repetition.assess(docs))}
    for doc_id, text in texts(docs):
        if len(text) > 100000:
            continue
        w = WORDS.findall(text)
        r = got[doc_id]
        for size in (5, 6, 7, 9, 10, 8):
            windows = Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
            marked = {j for i in range(len(w) - size + 1) if windows[tuple(w[i : i + size])] > 1 for j in range(i, i + size)}
            assert math.isclose(r[f"cover_{size}"], sum(len(w[j]) for j in marked) / max(1, sum(map(len, w))))
        assert r["n_repeat_words"] == len(marked)
        for size in (2, 3, 4):
            windows = Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
            tops = [g for g, k in windows.items() if k > 1 and k == max(windows.values())]
            shares = [sum(len(w[j]) for j in {j for i in range(len(w) - size + 1) if tuple(w[i : i + size]) == g for j in range(i, i + size)}) / sum(map(len, w)) for g in tops]
            assert any(math.isclose(r[f"cover_{size}"], x) for x in shares or [0.0])
        seen, dup = set(), 0
        for line in text.split("\n"):
            if WORDS.search(line):
                dup += line in seen
                seen.add(line)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup)
        assert r["base_failed"] == (len(w) < 20 or 100 * len(marked) > 30 * len(w))
        assert not (r["base_failed"] and r["kept"])
    assert not got[10**6 + 3]["kept"]


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script></head><body>
<header><p>The site of the news and the weather in the town</p></header><div class="cookie-notice">We use cookies to give you the best of the web</div>
<ul><li><a href="/">Home</a></li><li><a href="/x">About the town</a></li></ul>
<h1>A title &amp; more</h1><p>This is the first paragraph of the text, and it is long enough to be of use to those who read it in the morning.</p>
<p>Short one.</p><p>And the second paragraph is as long as the first, so that it is clear to all that this is the text of the page,<br>
with a <a href="/y">link</a> in it.</p><form><p>Your name is the best of all the names in the world, is it not so?</p></form>
<section id="comments"><p>I think that this is the best text of all the texts in the world and that you should read it to the end.</p></section>
<footer>&copy; the owners of the site and of all that is in it</footer></body></html>"""


def test_main_text_without_article():
    text = main_text.main_text(PAGE)
    assert text.split("\n\n") == [
        "A title & more",
        "This is the first paragraph of the text, and it is long enough to be of use to those who read it in the morning.",
        "Short one.",
        "And the second paragraph is as long as the first, so that it is clear to all that this is the text of the page, with a link in it.",
    ]


PROSE = "This is the first paragraph of the text, and it is long enough to be of use to those who read it in the morning, and in the evening too."
MORE = "And the second paragraph is as long as the first, so that it is clear to all that this is the text of the page, as it has been said."
MENU = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/x'>About</a></li></ul></nav><div class='cookie-notice'>We use cookies to give you the best of the web, as all of them do, and you may say no to this.</div>"
TAIL = "<section id='comments'><article class='comment'><p>I think that this is the best of all the texts in the world and that you should read it to the end of the day.</p></article></section><footer>The owners of the site and of all that is in it</footer>"


@pytest.mark.parametrize("page, want", [
    (f"<body class='no-sidebar'>{MENU}<article><h1>T</h1><p>{PROSE}</p><p>{MORE}</p></article>{TAIL}</body>", ["T", PROSE, MORE]),
    (f"<body class='comments-open'>{MENU}<div><h1>T</h1><p>{PROSE}</p><p>{MORE}</p></div><footer>The owners</footer></body>", ["T", PROSE, MORE]),
    (f"<main class='has-menu'><h1>T</h1><p>{PROSE}</p></main>", ["T", PROSE]),
    (f"{MENU}<article><header><h1>T</h1></header><p>{PROSE}</p><p>Short.</p></article>{TAIL}", ["T", PROSE, "Short."]),
    (f"<form id='aspnet'>{MENU}<div><h1>T</h1><p>{PROSE}</p></div><footer>The owners of it</footer></form>", ["T", PROSE]),
    (f"<form><p>{PROSE}</p><p>{MORE}</p></form>", [PROSE, MORE]),
    (f"<div id='share-wrap'><p>{PROSE}</p><p>{MORE}</p></div>", [PROSE, MORE]),
    (f"<article><p>{PROSE} <math><mi>x</mi></math> {MORE}</p></article>", [f"{PROSE} x {MORE}"]),
    (f"<article><p>{PROSE}<script>var a='<p>';</script> {MORE}</p></article>", [f"{PROSE} {MORE}"]),
    ("<article><h1>T</h1><p>One.</p><p>Two.</p></article><footer>The owners of the site and of all that is in it</footer>", ["T", "One.", "Two."]),
    (f"{MENU}<div><h2>T</h2><p>{PROSE}</p><p>Short.</p><p>{MORE}</p></div><ul><li><a href='/z'>More of the same</a></li></ul>", ["T", PROSE, "Short.", MORE]),
    ("<div>" * 20000 + f"<p>{PROSE}</p>" + "</div>" * 20000, [PROSE]),
])
def test_main_text_of_page_kinds(page, want):
    assert main_text.main_text(page).split("\n\n") == want


def test_main_text_is_decided_by_density(pages):
    """Of the blocks that are kept, most are decided by density, the others by neighbours."""
    rules = Counter((b.label, b.rule) for r in pages.collect() for b in main_text.classified(r.html))
    kept = sum(n for (label, _), n in rules.items() if label == main_text.GOOD)
    assert rules[main_text.GOOD, "density"] > 0.5 * kept and rules[main_text.GOOD, "density"] + rules[main_text.GOOD, "neighbour"] == kept


def test_main_text_of_table(pages):
    import html

    whole = {r.page_id: r.html for r in pages.collect()}
    for r in main_text.extract(pages).collect():
        page = whole[r.page_id]
        body = page[page.index("<article>") + 9 : page.index("</article>")]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_main_text_of_odd_pages(spark):
    odd = [None, "", "plain <b>words", "<p", "<div class='a>b'><p>x", "<!-- never closed", "<script>never closed", "&lt;p&gt;"]
    df = spark.createDataFrame([(k, "u", h) for k, h in enumerate(odd)], "page_id bigint, url string, html string").withColumn("text", F.lit(1))
    got = {r.page_id: r.text for r in main_text.extract(df).collect()}
    assert got[0] == got[1] == "" and got[2] == "plain words" and got[7] == "<p>"


# Classifier ---------------------------------------------------------------------------------


def test_quality_model(spark):
    sf = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality_model.classify(docs, labels).toPandas()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    assert all(h == (zlib.crc32(str(d).encode()) % 5 == 0) for d, h in zip(got.doc_id, got.held_out))
    held = got[got.held_out].merge(labels.toPandas(), on="doc_id")
    up, down = held[held.quality == 1].score.to_numpy(), held[held.quality == 0].score.to_numpy()
    assert (up[:, None] > down[None, :]).mean() > 0.9


def test_quality_model_against_plain_version():
    """The fit of dense vectors by the same steps, written out, and the score of each text."""
    rng = np.random.default_rng(2)
    texts_of = lambda label, n: ["".join(rng.choice(list("abcde" if label else "defgh"), 30)) for _ in range(n)]
    texts_in = texts_of(0, 20) + texts_of(1, 30)
    labels = np.array([0] * 20 + [1] * 30)
    rows_in = [quality_model.ngrams(t) for t in texts_in]
    x = np.zeros((50, 1 << quality_model.BITS))
    for i, f in enumerate(rows_in):
        x[i, f] = 1
    up, down = 1 + x[labels == 1].sum(axis=0), 1 + x[labels == 0].sum(axis=0)
    ratio = np.log(up / up.sum()) - np.log(down / down.sum())
    v = x * ratio
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v = np.hstack([v, np.ones((50, 1))])  # the bias
    y, alpha, w, order = np.where(labels == 1, 1.0, -1.0), np.zeros(50), np.zeros(v.shape[1]), np.random.default_rng(7)
    for _ in range(12):
        for i in order.permutation(50):
            most = 50 / (2 * (30 if y[i] > 0 else 20))
            new = min(max(alpha[i] - (y[i] * (v[i] @ w) - 1) / (v[i] @ v[i]), 0), most)
            w += (new - alpha[i]) * y[i] * v[i]
            alpha[i] = new
    assert all((quality_model.unpacked(quality_model.packed(f)) == f).all() for f in [*rows_in, rows_in[0][:0]])
    model = quality_model.fit_margin(rows_in, labels)
    assert np.allclose([model.margin(f) for f in rows_in], v @ w, atol=1e-4)
    whole = quality_model.fit(rows_in, labels)
    scores = [whole.score(t) for t in [*texts_in, ""]]
    assert all(0 <= p <= 1 for p in scores) and min(scores[20:50]) > max(scores[:20])
    # Every n-gram of one to four bytes has a feature, and no other.
    assert len(quality_model.ngrams("abca")) == len({"abca"[i : i + n] for n in (1, 2, 3, 4) for i in range(5 - n)})


def test_quality_model_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = quality_model.classify(docs, none).toPandas()
    assert set(got.score) == {0.5} and len(got) == docs.count()


# Exact dedup and mixing -----------------------------------------------------------------------


def exact_plain(docs):
    groups = defaultdict(list)
    for d, t in texts(docs):
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((-len(t), d))
    return {d: (min(g)[1], len(g), hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for _, d in g}


@pytest.mark.parametrize("digest_bytes", [32, 1])
def test_exact_dedup(docs, digest_bytes):
    """Also with digests of one byte, where hits must be told apart by their bytes."""
    want = exact_plain(docs)
    got = rows(exact_dedup.classify(docs, digest_bytes))
    assert {r["doc_id"]: (r["keep_id"], r["group_size"], r["text_sha256"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in got)


def test_repeated_rows_leave_one(docs):
    twice = docs.union(docs)
    assert sum(r["kept"] for r in rows(exact_dedup.classify(twice))) == exact_dedup.dedup(twice).count() == len({v[2] for v in exact_plain(docs).values()})


def test_digest_index_over_several_flushes(spark, docs, monkeypatch):
    """Three flushes of three runs each, merged two by two: four levels."""
    monkeypatch.setattr(exact_dedup, "FAN_IN", 2)
    index = exact_dedup.DigestIndex(spark)
    entries = exact_dedup.digested(docs)
    for k in range(3):
        index.flush(entries.where(F.col("doc_id") % 3 == k))
    merged = index.compact()
    assert index.levels >= 3
    assert {bytes(r.digest).hex(): r.keep_id for r in merged.collect()} == {v[2]: v[0] for v in exact_plain(docs).values()}
    one = merged.first()
    assert index.lookup(merged, [bytes(one.digest)]).first().keep_id == one.keep_id


def test_only_texts_of_hits_are_verified(spark, docs):
    index = exact_dedup.DigestIndex(spark)
    index.flush(exact_dedup.digested(docs))
    hits = exact_dedup.hit_filter(index.compact())
    groups = Counter(v[2] for v in exact_plain(docs).values())
    assert hits.count() <= sum(n > 1 for n in groups.values()) < len(groups)
    plan = exact_dedup.colliding(docs, hits)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan


def test_mixing_at_high_rates(spark):
    """Rates beyond one draw: the sum of the draws, and the SQL agrees; a source without text has rate one."""
    data = [(k, "a" * (1 if k < 40 else 4000), "rare" if k < 40 else "big") for k in range(60)] + [(100 + k, "", "none") for k in range(50)]
    df, weights = spark.createDataFrame(data, "doc_id bigint, text string, source string"), {"rare": 0.2, "none": 0.1}
    got = mixing.report(df, weights).toPandas()
    rate = 0.2 * 80040 / 40
    assert mixing.draws_of(rate) > 10 and abs((got.source == "rare").sum() / 40 - rate) < 5 * math.sqrt(rate / 40)
    assert 20 < (got.source == "none").sum() < 90
    con, documents = duckdb.connect(), df.toPandas()  # noqa: F841
    want = con.sql(mixing.report_sql(weights)).df()
    key = ["doc_id", "copy"]
    assert got.sort_values(key)[["doc_id", "n_copies", "copy", "order_key"]].values.tolist() == want.sort_values(key)[["doc_id", "n_copies", "copy", "order_key"]].values.tolist()


def test_mixing(docs):
    weights = {"src0": 0.5, "src1": 0.1}
    got = mixing.report(docs, weights).toPandas()
    sizes = Counter()
    for r in docs.collect():
        sizes[r.source if r.source in weights else ""] += len(r.text or "")
    rate = {g: (weights.get(g, 0.4)) * sum(sizes.values()) / n for g, n in sizes.items()}
    copies = got.groupby("doc_id").size()
    for r in docs.collect():
        u = int(hashlib.md5(f"{mixing.SEED}:{r.doc_id}".encode()).hexdigest()[:13], 16) / (1 << 52)
        lam, k, p = rate[r.source if r.source in weights else ""], 0, 0.0
        while True:
            p += math.exp(k * math.log(lam) - lam - math.lgamma(k + 1))
            if p > u:
                break
            k += 1
        assert copies.get(r.doc_id, 0) == k
    assert mixing.mix(docs, weights).columns == docs.columns and mixing.mix(docs, weights).count() == len(got)


# Empty tables -----------------------------------------------------------------------------------


def test_empty_tables(spark, empty, pages):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    results = [
        packing.pack(empty), simhash.classify(empty), simhash.similar_dedup(empty), secrets.report(empty), language_model.score(empty), url_filter.judge(pages.limit(0)),
        repetition.assess(empty), main_text.extract(pages.limit(0)), quality_model.classify(empty, labels), quality_model.keep_good(empty, labels), exact_dedup.classify(empty),
        exact_dedup.dedup(empty), mixing.report(empty), mixing.mix(empty),
    ]
    assert [r.count() for r in results] == [0] * len(results)


def test_odd_rows_pass_everywhere(spark, docs):
    """Rows repeated, nulls and clashing columns: nothing fails, nothing is lost."""
    twice = docs.union(docs.where("doc_id >= 1000000"))
    n = twice.count()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for result in (simhash.classify(twice), secrets.report(twice), language_model.score(twice), repetition.assess(twice), quality_model.classify(twice, labels), exact_dedup.classify(twice)):
        assert result.count() == n
    assert simhash.similar_dedup(twice).columns == docs.columns
    packed = packing.pack(twice).toPandas()
    assert packed.groupby("sequence_id").length.sum().max() <= 1024
