"""The stages in a chain, each against a plain version on what its predecessor kept."""

import re
from collections import Counter
from itertools import combinations

import pandas as pd
import pytest

import corpus_pipeline
from quadmill.llm import mixing, packing, quality_model, simhash
from quadmill.llm.common import stored

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, node bigint, length bigint, _copy string"
SPACE = re.compile(r"[\x20\x09-\x0D]")


@pytest.fixture(scope="module")
def odd(spark):
    """Some documents with copies, near copies, nulls, empty and long texts, repeated rows and clashing columns."""
    own = pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id").head(60)
    data = [(int(r.doc_id), r.text, r.lang, r.source, int(r.n_chars)) for r in own.itertuples()]
    for k, (doc_id, text, lang, source, n) in enumerate(list(data[:30])):
        data.append((5000 + k, text.replace(" ", "  ", 3) if k % 2 else text, lang, source, n))
        data.append((6000 + k, text + " one more word", lang, None if k % 3 else source, n))
    data += [(7000, None, None, None, None), (7001, "", "en", "src0", 0), (7002, " \n", None, "src1", 2), (7003, data[3][1] + " " + "long words follow here " * 8000, "en", "src1", 1)]
    data += [data[2], data[2], (7000, None, None, None, None)]
    return spark.createDataFrame([(*r, 1, 2, "x") for r in data], DOCS).repartition(3).cache()


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def plain_good(spark, docs):
    model = quality_model.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    return Counter({r: n for r, n in rows(docs).items() if model.score(r[1] or "") >= quality_model.KEEP_FROM})


def plain_exact(spark, docs):
    best = {}
    for r in rows(docs):
        key = SPACE.sub("", r[1] or "")
        if key not in best or (-len(r[1] or ""), r[0]) < (-len(best[key][1] or ""), best[key][0]):
            best[key] = r
    return Counter(best.values())


def plain_near(spark, docs):
    have = sorted(rows(docs))
    sets = [set(simhash.shingle_set(r[1] or "").tolist()) for r in have]
    fps = [simhash.fingerprint(r[1], simhash.NEAR_WORDS) for r in have]
    root = list(range(len(have)))

    def top(i):
        return i if root[i] == i else top(root[i])

    for i, j in combinations(range(len(have)), 2):
        both, either = len(sets[i] & sets[j]), len(sets[i] | sets[j])
        if both >= simhash.SIMILARITY * either - 1e-9 or (fps[i] ^ fps[j]).bit_count() <= simhash.LINK_BITS:
            a, b = sorted((top(i), top(j)))
            root[b] = a  # the smallest place, so the smallest doc_id
    return Counter(have[i] for i in range(len(have)) if top(i) == i)


def plain_mix(spark, docs):
    copies = Counter(r.doc_id for r in mixing.report(docs).collect())
    return Counter({r: copies[r[0]] for r in rows(docs) if copies[r[0]]})


def test_stages_against_plain_versions(spark, odd):
    docs, plain = odd, (plain_good, plain_exact, plain_near, plain_mix)
    for (name, stage), want in zip(corpus_pipeline.STAGES, plain):
        out = stored(stage(spark, docs, SF), name)
        assert out.columns == docs.columns
        got = rows(out)
        assert got == want(spark, docs), name
        assert got
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).toPandas()
    assert packed.groupby("sequence_id").length.sum().max() <= 1024
    ids = packing.pack(docs.dropDuplicates(["doc_id"])).toPandas().groupby("doc_id").length.sum()
    times = Counter(r.doc_id for r in docs.select("doc_id").collect())
    assert packed.groupby("doc_id").length.sum().to_dict() == {k: n * times[k] for k, n in ids.items()}


def test_stages_on_odd_rows(spark, odd):
    """Without the classifier, which could drop them: copies and near copies, nulls and empty texts."""
    exact = stored(corpus_pipeline.drop_exact_copies(spark, odd, SF), "odd-exact")
    assert rows(exact) == plain_exact(spark, odd)
    near = stored(corpus_pipeline.drop_near_copies(spark, exact, SF), "odd-near")
    assert rows(near) == plain_near(spark, exact)
    assert near.count() < exact.count() < odd.count()


def test_empty_table_passes_all_stages(spark, odd):
    docs = odd.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        assert docs.count() == 0


def test_run_packs_what_is_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    packed = corpus_pipeline.run(spark, SF).toPandas()
    assert packed.groupby("sequence_id").length.sum().max() <= 1024
    assert 0 < packed.doc_id.nunique() < docs.count()
