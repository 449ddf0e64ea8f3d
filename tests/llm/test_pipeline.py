"""The pipeline's stages against brute force, and the entry without the subpackage."""

import subprocess
import sys
import textwrap

import corpus_pipeline as C
import numpy as np
from tests.llm.conftest import SF, same
from tests.llm.test_dedup import slow_components, slow_fingerprint
from tests.llm.test_rules_and_decontamination import brute
from tidewater.llm.queries import vocabulary_file


def test_stages(spark, docs, tmp):
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp}/{k}")
        out = spark.read.parquet(f"{tmp}/{k}")
        if k < len(C.STAGES) - 1:
            assert out.columns == columns
        kept[name] = (docs, docs := out)
    before, after = kept["language_id"]
    assert after.count() >= 0.98 * before.count()
    before, after = kept["line_dedup"]
    assert after.count() == before.count() and after.selectExpr("sum(length(text))").first()[0] < before.selectExpr("sum(length(text))").first()[0]
    assert after.where("n_chars <> length(text)").count() == 0
    before, after = kept["simhash_near_dedup"]
    want = {c for i, _, c in slow_components([(r["doc_id"], slow_fingerprint(r["text"])) for r in before.collect()])}
    assert {r["doc_id"] for r in after.collect()} == want and after.count() == len(want)
    before, after = kept["decontamination"]
    items = [(str(r[0]), r[1]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert same(after.collect(), [r for r in before.collect() if not brute(r["text"], items)[-1]])
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(vocabulary_file("word_bpe_49k.json"))
    before, after = kept["bpe"]
    text = {r["doc_id"]: r["text"] for r in before.collect()}
    assert after.count() == len(text)
    for r in after.collect():
        ids = library.encode(text[r["doc_id"]] or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == ids and r["n_tokens"] == len(ids)
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_run(spark):
    assert set(C.run(spark, SF).columns) == {"doc_id", "n_tokens", "ids", "decoded"}


def test_entry_works_without_the_subpackage():
    code = """
        import sys
        class Absent:
            def find_spec(self, name, path=None, target=None):
                if name == "corpus_pipeline" or name.startswith("tidewater.llm"):
                    raise ModuleNotFoundError(name=name)
        sys.meta_path.insert(0, Absent())
        import __spark_entry__ as e
        assert e.queries() and not [q for q in e.queries() if q.startswith("op") and q[2].isdigit()]
    """
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], check=True, cwd=C.__file__.rsplit("/", 1)[0], timeout=120)
