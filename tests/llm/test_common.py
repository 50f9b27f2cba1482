from types import SimpleNamespace

import pytest

from helixframe.llm import common


def test_rows_are_told_apart_whatever_the_map(spark, monkeypatch):
    """With a map of two bits nearly all rows may be among the keys; the result is the same."""
    docs = spark.createDataFrame([(i % 7 or None, str(i % 5), i) for i in range(70)], "a long, b string, n long").repartition(3)
    keys = spark.createDataFrame([(None, "0"), (3, "1"), (3, "1"), (99, "2")], "a long, b string")
    for bits in (2, 1 << 27):
        monkeypatch.setattr(common, "MAP_BITS", bits)
        gone = {r.n for r in common.without(docs, keys, ["a", "b"]).collect()}
        assert gone == {i for i in range(70) if (i % 7 or None, str(i % 5)) not in ((None, "0"), (3, "1"))}
        one = common.one_each(docs, keys, ["a", "b"]).collect()
        assert len(one) == 70 - 2 and {(r.a, r.b) for r in one} == {(r.a, r.b) for r in docs.collect()}
        assert common.without(docs, keys.limit(0), ["a", "b"]).count() == 70


def test_work_tables_never_go_to_one_machine_of_a_cluster():
    def session(master, conf):
        context = SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=lambda k, d=None: conf.get(k, d)))
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)))

    here = {"spark.sql.warehouse.dir": "/tmp/w/"}
    assert common.shared_dir(session("local[8]", here)) == "/tmp/w/_work" == common.shared_dir(session("local", here))
    for master in ("spark://a:7077", "yarn", "local-cluster[3,2,1024]"):
        assert common.shared_dir(session(master, here | {"spark.checkpoint.dir": "hdfs://a/b/"})) == "hdfs://a/b"
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            common.shared_dir(session(master, here))
