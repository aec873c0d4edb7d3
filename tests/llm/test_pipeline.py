"""The pipeline's stages, each against brute force on what it was given."""

from collections import Counter

import brute
import pytest
from test_llm_operators import _tokenized, check_packing

import corpus_pipeline
from ledgerlake.llm.common import written

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def _rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_stay(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    before, after = _rows(stages[0]), _rows(stages[1])
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert set(after) < set(before) and all(after[i] == before[i] for i in after)
    clean = [i for i in before if labels.get(i) == 0]
    assert sum(i in after for i in clean) >= 0.99 * len(clean)
    toxic = [i for i in before if labels.get(i) == 1]
    assert sum(i not in after for i in toxic) >= 0.7 * len(toxic)


def test_one_of_each_group_of_near_copies_stays(stages):
    before, after = _rows(stages[1]), _rows(stages[2])
    want = brute.jaccard([(i, r.text) for i, r in before.items()])
    assert set(after) == {i for i, _, c in want if i == c}
    assert all(after[i] == before[i] for i in after)


def test_secrets_are_redacted(stages):
    before, after = _rows(stages[2]), _rows(stages[3])
    assert set(after) == set(before)
    for i, r in after.items():
        found = sum(brute.secret_base(before[i].text)[:3])
        if found:
            assert "[secret]" in r.text and r.n_chars == len(r.text)
            assert not any(brute.secret_base(r.text)[:3])
        elif "[secret]" not in (r.text or ""):
            assert r == before[i]


def test_mix_takes_documents_once_or_twice(stages):
    before = _rows(stages[3])
    times = Counter(r.doc_id for r in stages[4].collect())
    assert set(times) <= set(before) and set(times.values()) <= {1, 2}
    size = {i: len(brute.words(r.text)) for i, r in before.items()}
    total = sum(size.values())
    assert 0 < sum(n * size[i] for i, n in times.items()) <= 1.5 * total * 1.05
    assert {r.doc_id: r.text for r in stages[4].collect()}.items() <= {i: r.text for i, r in before.items()}.items()


def test_everything_is_packed(stages):
    docs = [(r.doc_id, r.text) for r in stages[4].collect()]
    times = Counter(i for i, _ in docs)
    rows = [tuple(r) for r in stages[5].select("doc_id", "piece", "start", "length", "ids_crc32",
                                               "sequence_id", "offset").collect()]
    # copies of one document are documents of their own: number them
    seen, named = Counter(), []
    for r in sorted(rows):
        named.append(((r[0], seen[r[0], r[1]]), *r[1:]))
        seen[r[0], r[1]] += 1
    ids = _tokenized(dict(docs).items())
    used, least = check_packing(named, {(i, k): ids[i] for i, n in times.items() for k in range(n)})
    assert used <= least * 1.005 + 1


def test_run_is_the_stages(spark, stages):
    assert corpus_pipeline.run(spark, SF).count() == stages[-1].count()


CLASH = ["mix_copies", "mix_copy", "copies", "id", "gone", "row", "t", "col", "size", "pattern", "score", "redacted", "of"]


@pytest.mark.parametrize("kind", ["rows", "none"])
def test_stages_take_odd_rows(spark, kind):
    """NULLs, empty and repeated rows, empty tables and clashing names."""
    from test_llm_operators import odd_rows

    rows = [(*r, None if r[1] is None else len(r[1]), *[7] * len(CLASH)) for r in odd_rows()]
    rows += [(None, "no id", None, None, 5, *[7] * len(CLASH)), rows[7], rows[0]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in CLASH)
    docs = spark.createDataFrame(rows, schema).repartition(4)
    docs = docs if kind == "rows" else docs.where("false")
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, SF), f"odd-{name}")
        assert name == "best_fit_packing" or out.columns == docs.columns
        assert (out.count() > 0) == (kind == "rows")
        docs = out
