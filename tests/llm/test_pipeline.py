"""The stages over a small corpus with planted cases, against what each has to do."""

import hashlib
import os

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline

from .test_jaccard_join import brute

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    from tallyhouse.llm.queries import importable

    importable(spark)
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    out["documents"] = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        path = str(folder / name)
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        rows = docs.collect()
        out[name] = {r.doc_id: r for r in rows}
        assert len(rows) == len(out[name])
    return out


def test_names_and_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "jaccard_join", "decontamination", "secrets", "bpe"]
    columns = [r.__fields__ for n in ["documents", *names[:-1]] for r in list(stages[n].values())[:1]]
    assert all(c == columns[0] for c in columns)


def test_each_stage_only_removes_or_masks(stages):
    names = ["documents", *[n for n, _ in corpus_pipeline.STAGES]]
    for before, after in zip(names[:-1], names[1:], strict=True):
        assert set(stages[after]) <= set(stages[before])
    for name in ("toxicity", "jaccard_join", "decontamination"):
        assert all(r == stages["documents"][k] for k, r in stages[name].items())
    assert set(stages["secrets"]) == set(stages["decontamination"]) == set(stages["bpe"])


def test_one_of_each_group_stays(stages):
    groups = brute([(k, r.text) for k, r in stages["toxicity"].items()])
    assert set(stages["jaccard_join"]) == {k for k, (_, c) in groups.items() if k == c}


def test_benchmark_items_are_gone(spark, stages):
    items = [" ".join(r.text.split()) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    holds = {k for k, r in stages["jaccard_join"].items() if any(i in " ".join(r.text.split()) for i in items)}
    assert holds and not holds & set(stages["decontamination"])
    assert len(stages["jaccard_join"]) - len(stages["decontamination"]) <= 1.5 * len(holds) + 2


def test_texts_change_only_where_secrets_were(stages):
    for k, r in stages["secrets"].items():
        before = stages["decontamination"][k]
        assert r.n_chars == len(r.text)
        if r.text != before.text:
            assert "[secret]" in r.text and set(r.text.split("[secret]")[0]) <= set(before.text)


def test_tokens_are_the_librarys(stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for k, r in stages["bpe"].items():
        ids = library.encode(stages["secrets"][k].text, add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())


def test_run_equals_its_stages(spark, stages):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert got == {k: (r.n_tokens, r.ids_sha256) for k, r in stages["bpe"].items()}


def test_odd_rows_pass_every_stage(spark, odd, nothing):
    for docs, n in ((odd, None), (nothing, 0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_DIR)
        rows = docs.collect()
        if n == 0:
            assert rows == []
        else:
            # One of 3 and its copies stays, everything else passes.
            assert sorted(str(r.doc_id) for r in rows) == sorted(map(str, [1, 2, 3, 5, 6, 7, 8, None]))
