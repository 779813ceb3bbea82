import numpy as np

from lexspark.llm import common, simhash


def _plans(monkeypatch, module):
    """Plans of what the module writes, gathered as it writes."""
    plans, write = [], common.materialize

    def spy(df, name, *args, **kw):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name, *args, **kw)

    monkeypatch.setattr(module, "materialize", spy)
    return plans


def test_joins_of_many_fingerprints_are_shuffled_whatever_their_files_size(spark, monkeypatch):
    """A hundred rows stand for 2^17: under Spark's threshold of 10 MB such joins were broadcast, exploded rows too."""
    monkeypatch.setattr(common, "BROADCAST_ROWS", 100, raising=False)
    values = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 150).tolist()
    fps = common.materialize(spark.createDataFrame([(v,) for v in values], "fp long"), "fps")
    written, rounds = _plans(monkeypatch, simhash), _plans(monkeypatch, common)
    simhash.links(fps)
    assert "BroadcastHashJoin" not in dict(written)["files"]
    chain = common.materialize(spark.range(300).selectExpr("id AS u", "id + 1 AS v"), "chain")
    assert [r["root"] for r in common.connected_components(chain).select("root").distinct().collect()] == [0]
    stars = [p for n, p in rounds if n == "star"]
    assert stars and not any("BroadcastHashJoin" in p for p in stars)
