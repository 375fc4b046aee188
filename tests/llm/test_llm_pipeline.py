"""The corpus pipeline against brute-force versions of its stages."""

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from test_llm_edges import brute_line_dedup
from test_llm_queries import brute_components, check_packing
from tillroll.llm import classifier, quality_rules
from tillroll.llm.common import schema_of, table

SF = "/root/testdata/sf0.01"  # enough labels for the classifier to reject some


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The table after every stage but the last, as written, by name; first the documents."""
    folder = tmp_path_factory.mktemp("stages")
    docs = table(spark, SF, "documents")
    out = [{r.doc_id: r for r in docs.collect()}]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, SF).write.parquet(str(folder / str(i)))
        docs = spark.read.parquet(str(folder / str(i)))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.append({r.doc_id: r for r in docs.collect()})
    return out


def texts(rows):
    return {d: r.text or "" for d, r in rows.items()}


def test_order_of_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "quality rules", "line dedup", "MinHash near-dedup", "packing"]


def test_classifier_stage(spark, stages):
    model = classifier.fit_quality(table(spark, SF, "documents"), table(spark, SF, "labels"))
    want = {d for d, t in texts(stages[0]).items()
            if model.score(np.array([classifier.statistics(t.encode())], float))[0] >= 0.7}
    assert set(stages[1]) == want and 0 < len(want) < len(stages[0])


def test_rules_stage(stages):
    for d, r in stages[1].items():
        found, stay = quality_rules.judge((r.text or "").encode(), quality_rules.Rules())
        assert (d in stages[2]) == found["kept"]
        if found["kept"]:
            assert stages[2][d].text == b"\n".join(stay).decode() and stages[2][d].n_chars == len(stages[2][d].text)


def test_line_stage(stages):
    assert texts(stages[3]) == {d: t for d, (_, t) in brute_line_dedup(texts(stages[2])).items()}


def test_near_dedup_stage(stages):
    assert set(stages[4]) == {d for d, x in brute_components(texts(stages[3]), 5).items() if x[2]}


def test_run_packs_what_is_left(spark, stages):
    from tokenizers import Tokenizer

    check_packing(corpus_pipeline.run(spark, SF).collect(), texts(stages[4]),
                  Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))


def test_run_on_empty_tables(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.createDataFrame([], schema_of(name)).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_run_on_odd_documents(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows and ids, clashing extra columns: through all stages."""
    import random

    from tokenizers import Tokenizer

    rng = random.Random(8)
    prose = lambda n: " ".join(f"Word{rng.randrange(10 ** 6)} has a no{rng.randrange(10 ** 6)}." for _ in range(n))
    first, shared = prose(30), "\n".join(prose(4) for _ in range(3))
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "too short"), (4, first), (5, first), (6, prose(6000)), (7, prose(30) + "\n" + shared),
            (8, prose(30) + "\n" + shared), (8, "another text of the same id. " + prose(20)), (None, prose(25)), (9, "same same same " * 40)]
    rows += [rows[6]]  # a repeated row
    extra = [("z", 7, 7, 7)] * len(rows)
    d = spark.createDataFrame([(i, t, None, f"s{len(t or '') % 2}", None, *e) for (i, t), e in zip(rows, extra)],
                              schema_of("documents") + ", id STRING, key INT, lines INT, sig INT")
    d.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(9)] + [(None, 1, 0), (4, None, None)], schema_of("labels")).write.parquet(
        str(tmp_path / "labels.parquet"))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # 5 copies 4; 8 loses the shared lines; the repeated row stays twice; short, empty and repetitive texts go
    kept = [first, rows[6][1], rows[6][1], rows[7][1], rows[8][1].split("\n")[0], rows[9][1], rows[10][1]]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted(len(tok.encode(t, add_special_tokens=False).ids) + 1 for t in kept)
    assert sum(p.length for p in pieces) == sum(want)
    assert sorted({p.doc_tokens for p in pieces}) == sorted(set(want))
    assert {p.doc_id for p in pieces} == {4, 6, 7, 8, None}
