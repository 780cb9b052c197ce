"""What workers hold between tasks."""

import time

import public_tokenizers
from tokenizers import Tokenizer

from celldex.llm import common, packing


def test_recent_words_stay_and_others_go():
    recent = packing.Recent(3)
    for i in range(20):
        recent.young[f"w{i}"] = b"x"
        recent.young.setdefault("often", b"o") if recent.get("often") is None else None
        recent.turn()
    assert recent.get("often") == b"o" and recent.get("w0") is None and len(recent.young) + len(recent.old) <= 8


def test_ids_are_the_librarys_whatever_is_held(monkeypatch):
    monkeypatch.setattr(packing, "MOST_CACHED", 4)
    path = public_tokenizers.path("word_bpe_49k.json")
    code, library = packing.Encoder(path), Tokenizer.from_file(path)
    for i in range(5):
        texts = [f"Alpha beta, GAMMA{i} delta. {'x' * i} é{i} beta", "", " \n", "alpha alpha"]
        assert [list(memoryview(b).cast("I")) if b else [] for b in code.texts(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_tasks_empty_caches_unless_they_keep_them(monkeypatch):
    held = {"a": 1}
    monkeypatch.setattr(common, "HELD", [held])
    assert list(common.lean(iter, keep=True)([1, 2])) == [1, 2] and held
    assert list(common.lean(iter)([1, 2])) == [1, 2] and not held


def test_written_tables_leave_no_shuffles(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {x.rpartition("/")[2] for x in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x}
    was, rows = shuffles(), spark.range(1000)
    out = common.written(rows.groupBy((rows["id"] % 7).alias("k")).count(), "counts")
    for _ in range(50):
        if not (left := shuffles() - was):
            break
        time.sleep(0.1)
    assert not left and out.count() == 7 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
