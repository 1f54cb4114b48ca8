"""The corpus pipeline, stage by stage against brute force, and the entry."""

import os
import shutil
import subprocess
import sys
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm import common, queries
from tessera.llm.exact_dedup import normalised

from test_dedup import brute_exact, brute_near
from test_mix_pack_tokens import check_packing, water_fill, words

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="module")
def sf_dir(spark, rows, tmp_path_factory):
    """Real documents, the odd rows and some repeated ones, without extras."""
    folder = str(tmp_path_factory.mktemp("tables"))
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame([(None if r[0] is None else r[0] + 10_000, *r[1:]) for r in rows], real.schema)
    real.unionByName(odd).unionByName(real.limit(5)).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return folder


def tuples(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_every_stage_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        path = common.scratch_path(spark, f"test-{name}")
        out.write.parquet(path)
        if name != "packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        seen[name] = (tuples(docs), spark.read.parquet(path))
        docs = spark.read.parquet(path)

    before, out = seen["language_id"]
    after = Counter(tuples(out))
    assert not after - Counter(before)
    gone = list((Counter(before) - after).elements())
    assert all(not any(map(str.isalpha, r[1] or "")) for r in gone if r[0] is None or r[0] < 10_000 or len(r[1] or "") < 3)
    assert all(any(map(str.isalpha, r[1] or "")) for r in after.elements())
    assert len(gone) < 0.2 * len(before)

    before, out = seen["exact_dedup"]
    kept = tuples(out)
    groups = brute_exact(before)
    assert len(kept) == len({g[4] for g in groups}) and not Counter(kept) - Counter(before)
    assert sorted(str(r[0]) for r in kept) == sorted(str(i) for i in {g[4]: g[1] for g in groups}.values())

    before, out = seen["near_dedup"]
    want = sorted(str(m[0]) for m in brute_near(before, 5, 80) if m[3])
    assert sorted(str(r[0]) for r in tuples(out)) == want

    before, out = seen["source_mix"]
    sizes, taken = Counter(), Counter()
    for r in before:
        sizes[r[3]] += len(words(r[1]))
    for r in tuples(out):
        taken[r[3]] += len(words(r[1]))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = water_fill(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(sizes.values()), 2)
    longest = {s: max(len(words(r[1])) for r in before if r[3] == s) for s in order}
    assert all(abs(taken[s] - target[s]) <= longest[s] / 2 + 1 for s in order)
    assert set(tuples(out)) <= set(before)  # every text as it came

    before, out = seen["packing"]
    check_packing(before, out.collect(), 4096)


def test_run_is_repeatable_and_cleans_up(spark, sf_dir):
    got = [sorted(map(str, corpus_pipeline.run(spark, sf_dir).select("doc_id", "start", "length", "ids_crc32").collect())) for _ in range(2)]
    assert got[0] == got[1] and got[0]


def test_empty_documents(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_a_thousand_sources_of_one_document_keep_whole_texts(spark, make):
    rows = [(i, f"only text of source {i} " + "word " * (i % 9), "en", f"s{i:04d}", 0) for i in range(1000)]
    rows += [(5000 + i, "a large source " * 40, "en", "big", 0) for i in range(20)]
    docs = make(rows).select("doc_id", "text", "lang", "source", "n_chars")
    out = corpus_pipeline.mix(spark, docs, "").collect()
    assert {tuple(r) for r in out} <= set(rows)
    sizes, got = Counter(), Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    for r in out:
        got[r["source"]] += len(words(r["text"]))
    order = sorted(sizes)
    target = water_fill(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(sizes.values()), 2)
    longest = {r[3]: len(words(r[1])) for r in rows}
    assert all(abs(got[s] - target[s]) <= longest[s] / 2 + 1 for s in order)


def test_stages_do_not_delete_what_others_still_read(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = corpus_pipeline.exact(spark, docs, sf_dir)
    second = corpus_pipeline.exact(spark, docs, sf_dir)
    assert second.count() == first.count() > 0


def test_release_deletes_only_what_is_named(spark):
    a, b = (common.staged(spark.range(3).toDF("x"), "t") for _ in range(2))
    first, second = common.scratch_tables()[-2:]
    common.release(spark, [first])
    assert b.count() == 3 and first not in common.scratch_tables() and second in common.scratch_tables()
    with pytest.raises(Exception):
        a.count()


def test_normalised_text_is_an_expression(docs):
    assert docs.select(normalised(F.col("text")).alias("n")).filter("n is null").count() == 0


def test_entry_lists_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES)
    assert Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER)).get_vocab_size() > 0


def test_library_works_without_the_subpackage(tmp_path):
    """The entry still imports, and lists the other queries, when the
    subpackage and the pipeline are absent."""
    target = tmp_path / "tessera"
    target.mkdir()
    for part in os.listdir(os.path.join(ROOT, "tessera")):
        if part not in ("llm", "__pycache__"):
            os.symlink(os.path.join(ROOT, "tessera", part), target / part)
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') for n in q), 'pipeline' in q, len(e.oracle_sql()) > 50)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert out.returncode == 0, out.stderr
    count, op, pipe, oracle = out.stdout.split()
    assert int(count) > 80 and (op, pipe, oracle) == ("False", "False", "True")
