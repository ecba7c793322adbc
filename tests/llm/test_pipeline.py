import numpy as np
import pytest

import corpus_pipeline as cp
from netsift.llm import toxicity as tx
from netsift.llm.common import table
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_packing import check_rows
from tests.llm.test_simhash import brute_fp, brute_groups
from tests.llm.test_toxicity import brute as brute_toxic

SF = "/root/testdata/sf0.001"
COLS = ["doc_id", "text", "lang", "source", "n_chars"]


def cut(rows, width=50):
    """Texts without the bytes of windows that start in a smaller document."""
    raw = {i: (t or "").encode() for i, t in rows}
    first = {}
    for i in sorted(raw):
        for s in range(len(raw[i]) - width + 1):
            first.setdefault(raw[i][s : s + width], i)
    out = {}
    for i, t in raw.items():
        keep = np.ones(len(t), bool)
        for s in range(len(t) - width + 1):
            if first[t[s : s + width]] < i:
                keep[s : s + width] = False
        out[i] = np.frombuffer(t, np.uint8)[keep].tobytes().decode(errors="ignore")
    return out


def test_run_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    model = tx.fit_toxicity(docs, table(spark, SF, "labels"))
    weight = dict(zip(model.feature, model.weight))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows = [(i, t) for i, t in rows if (weight[-2] if -2 in weight else brute_toxic(t or "", weight)) < tx.THRESHOLD]
    rows = [(i, t) for i, _, _, t in brute_lines(rows)]
    group = brute_groups([i for i, _ in rows], [brute_fp(t) for _, t in rows])
    rows = [(i, t) for (i, t), c in zip(rows, group) if i == c]
    texts = cut(rows)
    got = cp.run(spark, SF).collect()
    assert {r.doc_id for r in got} == set(texts)
    check_rows(got, texts)


def test_stages_return_the_columns_of_documents(spark):
    docs = table(spark, SF, "documents")
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == COLS and out.dtypes == docs.dtypes, name
        assert all(r.n_chars == len(r.text) for r in out.collect())


ODD = [(1, None, "en", "a", None), (2, "", None, "b", 0), (3, "same words here in both of them", "en", None, 3), (4, "same words here in both of them", "en", "c", 3),
       (None, "same words here in both of them", "en", "c", 3), (5, "long text " * 60_000, "en", "c", 3), (5, "long text " * 60_000, "en", "c", 3)]


@pytest.mark.parametrize("rows", [ODD, []])
def test_nulls_repeats_long_texts_and_empty_tables(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(2)
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    left = sorted((str(r.doc_id), len(r.text or "")) for r in docs.collect())
    # of the null and empty texts, and of documents left empty by line dedup, the smallest id stays; a null id stays as it is
    assert [i for i, _ in left] == (["1", "3", "5", "None"] if rows else [])
    assert docs.columns == COLS
    n = cp.STAGES[-1][1](spark, docs, SF).count()
    assert n >= 4 if rows else n == 0


def test_a_repeated_id_in_several_groups_keeps_one_row_of_each(spark):
    texts = {k: " ".join(f"{k}{i}" for i in range(40)) for k in "abcd"}
    rows = [(5, texts["a"]), (9, texts["a"]), (5, texts["b"]), (12, texts["b"]), (5, texts["a"]), (3, texts["c"]), (7, texts["c"]), (7, texts["d"]), (8, texts["d"]),
            (20, None), (20, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r.doc_id, r.text or "") for r in cp.simhash_dedup(spark, docs, SF).collect())
    assert got == [(3, texts["c"]), (5, texts["a"]), (5, texts["b"]), (7, texts["d"]), (20, "")]


def test_columns_named_like_the_stages_own(spark, tmp_path):
    """Every internal and result name of the stages, in lower and upper case, as an extra column."""
    import corpus_pipeline

    names = ("n_lines N_DROPPED n_bytes n_removed n_spans kept kept_sha256 d x h t o lo hi drop fresh batch shard data gone root score predicted "
             "held_out offending fingerprint component_id id fp u v __text __nth bucket strings").split()
    rows = [(i, f"Some words of document {i} are its own, and {i * 7} others.\nA line that all of them have in common.", "en", "s", 10) for i in range(8)]
    df = spark.createDataFrame([r + tuple(f"{n}{r[0]}" for n in names) for r in rows],
                               "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names))
    spark.createDataFrame([(0, 1, 0), (1, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, str(tmp_path))
        assert out.columns == df.columns
        for r in out.collect():
            assert all(r[n] == f"{n}{r.doc_id}" for n in names)
    assert corpus_pipeline.STAGES[-1][1](spark, df, str(tmp_path)).count() == 8
