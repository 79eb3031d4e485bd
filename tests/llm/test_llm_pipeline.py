from __future__ import annotations

import subprocess
import sys
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import __spark_entry__ as entry
import corpus_pipeline
from funnelmart.llm import near_dedup, quality
from funnelmart.llm.decontamination import Index, Rule
from funnelmart.llm.queries import QUERIES
from funnelmart.llm.words import hash_words
from funnelmart.session import shared_folder

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert [x for x in names if x.startswith(f"op{n}_")], n
    assert names["pipeline"] is corpus_pipeline.run
    assert set(QUERIES) <= set(names)


def test_stages_keep_columns_and_take_effect(spark, scratch, documents):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, [docs.count()]
    benchmark = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.keep(stage(spark, docs, FOLDER), name.replace(" ", "-"))
        kept.append(docs.count())
        rows = docs.collect()
        assert docs.columns[: len(columns)] == columns
        if stage is corpus_pipeline.dedup:
            again = near_dedup.near_duplicates(docs, scratch, by_group=True)
            assert again.where("kept").count() == len(rows)
        if stage is corpus_pipeline.decontaminate:
            index = Index(benchmark, Rule())
            assert not any(index.overlaps(w) for w in hash_words([r["text"] for r in rows]))
    assert docs.columns == [*columns, "shard", "slot"]
    assert kept[0] >= kept[1] > kept[2] > kept[3] > 0 and kept[4] == kept[5]


def test_run_agrees_with_its_stages_on_odd_rows(spark, odd, tmp_path):
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert found and {r["shard"] for r in found} <= set(range(16))
    spark.read.parquet(str(tmp_path / "documents.parquet")).where("false").write.parquet(str(tmp_path / "none/documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(str(tmp_path / f"none/{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_quality_stage_keeps_good_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.quality(spark, docs, FOLDER).collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in good) >= 0.98 * len(good)
    assert quality.CUT_SCORE == 0.3


def test_entry_works_without_the_subpackage(tmp_path):
    root = Path(entry.__file__).parent
    for part in ("funnelmart", "oracle", "__spark_entry__.py"):
        (tmp_path / part).symlink_to(root / part) if part != "funnelmart" else (tmp_path / part).mkdir()
    for part in (root / "funnelmart").iterdir():
        if part.name not in ("llm", "__pycache__"):
            (tmp_path / "funnelmart" / part.name).symlink_to(part)
    copy = tmp_path / "entry_copy.py"
    copy.write_text((root / "__spark_entry__.py").read_text())
    code = "import entry_copy as e; print(len(e.queries()), any(x.startswith('op') for x in e.queries()))"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=100)
    assert done.stdout.split()[1:] == ["False"], done.stderr


def as_rows(frame):
    return sorted(map(tuple, frame.select("doc_id", "shard", "slot").collect()))


def test_runs_at_once_and_one_after_another_keep_their_tables(spark):
    first = corpus_pipeline.run(spark, FOLDER)
    with ThreadPoolExecutor(2) as threads:
        both = list(threads.map(lambda _: as_rows(corpus_pipeline.run(spark, FOLDER)), range(2)))
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    corpus_pipeline.quality(spark, docs, FOLDER)  # a stage on its own starts a run of its own
    assert as_rows(first) == both[0] == both[1]


def test_a_closed_run_leaves_nothing(spark):
    def folders():
        return set(Path(shared_folder(spark), "llm").glob("*"))

    before = folders()
    run = corpus_pipeline.Run(spark)
    assert run.documents(FOLDER).count() > 0
    assert 0 < len([x for x in folders() - before if any(x.iterdir())])
    run.close()
    assert not [x for x in folders() - before if any(x.iterdir())]
