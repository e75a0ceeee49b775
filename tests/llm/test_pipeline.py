"""The stages against brute force, and the entry module without the optional folder."""

import subprocess
import sys
import textwrap
from pathlib import Path

import public_tokenizers
import tiktoken

import corpus_pipeline
from basketry.llm import bpe
from tests.llm import fixtures, test_decontamination, test_lines, test_shingles

ROOT = Path(__file__).resolve().parents[2]


def write(spark, folder, docs, items):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    return f"file://{folder}"


def test_run_equals_brute_force(spark, tmp_path):
    passage = fixtures.prose(90, 60)
    base = fixtures.prose(91, 90)
    texts = [
        None, "", "123 !!!", base + "\n" + fixtures.prose(92, 40), base, fixtures.change(base, 90, 1),
        "intro " + passage + " outro", fixtures.prose(93, 400) + "\n" + passage[:20],
        fixtures.prose(94, 20) + "\n" + fixtures.prose(95, 20), fixtures.prose(94, 20),
        fixtures.prose(96, 50), "a " + fixtures.prose(96, 50) + " b",
    ]
    docs = fixtures.table(spark, texts)
    sf = write(spark, tmp_path / "t", docs, [(1, passage)])
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf).collect()}

    left = {k: t for k, t in enumerate(texts) if t and any(c.isalpha() for c in t)}
    rows = list(left)
    for row, gone in test_lines.brute_force(list(left.items())).items():
        doc_id = rows[row]
        kept = [p for k, p in enumerate(left[doc_id].split("\n")) if k not in gone]
        left[doc_id] = "\n".join(kept)
    left = {k: t for k, t in left.items() if t}
    ids = sorted(left)
    _, _, group = test_shingles.brute_force([(k, left[k]) for k in ids])
    left = {k: left[k] for n, k in enumerate(ids) if group[n] == n}
    for k in list(left):
        found, hit, _ = test_decontamination.brute_force(left[k], [(1, passage)])
        if hit and 20 * len(hit) >= len(found):
            del left[k]
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    whole = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert {k: r["ids"] for k, r in got.items()} == {
        k: whole.encode_ordinary(t) for k, t in left.items()}
    assert {3, 7, 8, 10} <= set(got) and not {0, 1, 2, 4, 6, 9} & set(got)


def test_stages_keep_the_columns_and_stand_the_edges(spark, tmp_path):
    docs = fixtures.edges(spark)
    sf = write(spark, tmp_path / "t", docs, [(1, fixtures.prose(5, 30)), (None, None)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs_out = stage(spark, docs, sf)
        assert docs_out.schema.fieldNames() == docs.schema.fieldNames(), name
        assert docs_out.count() <= docs.count()


def test_empty_tables(spark, tmp_path):
    sf = write(spark, tmp_path / "t", fixtures.empty(spark), [])
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_entry_works_without_the_folder():
    code = textwrap.dedent("""
        import sys
        class Absent:
            def find_spec(self, name, path=None, target=None):
                if name in ("basketry.llm", "corpus_pipeline"):
                    raise ModuleNotFoundError(name)
        sys.meta_path.insert(0, Absent())
        import __spark_entry__ as e
        assert "pipeline" not in e.queries() and len(e.queries()) > 40
    """)
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
