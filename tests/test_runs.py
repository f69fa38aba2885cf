"""Batches judged once, versions of tables, the stage runner and the masked view."""

import pytest
from pyspark.sql import functions as F

from civicframe.operators.masked import assert_masked, masked_texts, publish_masked
from civicframe.sources import versions as v
from civicframe.streaming.ingest import new_files
from civicframe.streaming.judging import NotReady, answers, control, judged_once, pending


def test_a_batch_is_asked_once_though_the_run_dies(spark, tmp_path):
    source, root, check = (str(tmp_path / x) for x in ("in", "judge", "check"))
    asked, ready, dies = [], set(), []
    spark.createDataFrame([(1, "a"), (2, "b")], "id long, q string").coalesce(1).write.parquet(source)

    def ask(batch, number):
        path = f"{tmp_path}/service-{number}"
        batch.write.parquet(path)
        asked.append(sorted(r.id for r in batch.collect()))
        return path

    def fetch(session, reference):
        if reference not in ready:
            raise NotReady(reference)
        if dies:
            raise RuntimeError("killed between the phases")
        return session.read.parquet(reference).select("id", F.upper("q").alias("answer"))

    def run():
        stream = new_files(spark, source, spark.read.parquet(source).schema)
        stream.writeStream.foreachBatch(judged_once(root, ask, fetch)).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()

    for fail in ("not ready", "dies"):
        with pytest.raises(Exception, match="NotReady|killed"):
            run()
        assert asked == [[1, 2]] and answers(spark, root) is None
        assert [r.batch for r in pending(spark, root).collect()] == [0]
        ready.add(f"{tmp_path}/service-0")
        dies[:] = [1] if fail == "not ready" else []
    run()
    assert asked == [[1, 2]] and pending(spark, root).count() == 0
    assert sorted(map(tuple, answers(spark, root).select("id", "answer").collect())) == [(1, "A"), (2, "B")]
    spark.createDataFrame([(3, "c")], "id long, q string").coalesce(1).write.mode("append").parquet(source)
    ready.add(f"{tmp_path}/service-1")
    run()
    assert asked == [[1, 2], [3]] and answers(spark, root).count() == 3
    judged_once(root, ask, fetch)(spark.createDataFrame([(9, "x")], "id long, q string"), 0)
    assert len(asked) == 2 and control(spark, root).count() == 4


def test_versions(spark, tmp_path):
    root = str(tmp_path / "t")
    numbers = lambda df: sorted(r.id for r in df.collect())
    assert v.current(spark, root) is None and v.versions(spark, root).count() == 0
    assert v.publish(spark.range(10), root, v.no_shrink()) == 1
    with pytest.raises(ValueError, match="7 rows"):
        v.publish(spark.range(7), root, v.no_shrink())
    assert numbers(v.current(spark, root)) == list(range(10))
    grown = v.current(spark, root).unionByName(spark.range(10, 12))
    assert v.publish(grown, root, v.no_shrink()) == 2 and numbers(v.current(spark, root)) == list(range(12))
    assert v.restore(spark, root, 1) == 3 and numbers(v.current(spark, root)) == list(range(10))
    assert sorted((r.version, r.of) for r in v.versions(spark, root).collect()) == [(1, 1), (2, 2), (3, 1)]
    with pytest.raises(ValueError, match="no version 9"):
        v.restore(spark, root, 9)
    with pytest.raises(Exception, match="(?i)exists"):
        v._commit(spark, root, 3, "other", 3)


def test_a_failed_stage_leaves_its_former_version(spark, tmp_path):
    root = str(tmp_path / "r")

    def broken(session):
        return session.range(5).select(F.raise_error(F.lit("no network")).cast("long").alias("id"))

    first = v.run_stages(spark, root, [("a", lambda s: s.range(3), False), ("b", lambda s: s.range(4), True)])
    assert sorted(map(tuple, first.collect())) == [("a", "done", 1, None), ("b", "done", 1, None)]
    later = {r.stage: r for r in v.run_stages(spark, root, [("b", broken, True), ("new", broken, True), ("a", lambda s: s.range(9), False)]).collect()}
    assert (later["b"].state, later["b"].version, later["new"].version, later["a"].version) == ("failed", 1, None, 2) and later["b"].error
    assert v.current(spark, f"{root}/b").count() == 4 and v.current(spark, f"{root}/new") is None
    with pytest.raises(Exception, match="no network"):
        v.run_stages(spark, root, [("a", broken, False), ("c", lambda s: s.range(1), False)])
    assert v.current(spark, f"{root}/a").count() == 9 and v.current(spark, f"{root}/c") is None


def test_masked_view_and_a_planted_bypass(spark, tmp_path):
    raw, view = str(tmp_path / "raw"), str(tmp_path / "view")
    rows = [(1, "Titel", "mail jan@x.be of BE12 3456 7890 1234"), (2, None, "niets"), (3, "half@masker.be", "rr 85.01.02-123.45 einde"), (4, "x", None)]
    spark.createDataFrame(rows, "id long, title string, text string").write.parquet(raw)
    items = spark.read.parquet(raw)
    publish_masked(items, view, "id", ["title", "text"])
    got = {r.id: r for r in v.current(spark, view).collect()}
    assert not any(r.held for r in got.values()) and "@" not in got[1].text and "7890" not in got[1].text and got[2].title is None and got[4].text is None
    broken = masked_texts(items, "id", ["title", "text"], masks=(lambda t: F.regexp_replace(t, "half@", "h@"),))
    held = {r.id: (r.held, r.title, r.text) for r in broken.collect()}
    assert held == {1: (True, None, None), 2: (False, None, "niets"), 3: (True, None, None), 4: (False, "x", None)}
    safe = v.current(spark, view).select(F.concat("title", F.lit(" "), "text").alias("prompt"))
    assert assert_masked(safe, [raw]) is safe
    around = v.current(spark, view).join(items.select("id", F.substring("text", 1, 5).alias("start")), "id").select(F.concat("title", "start").alias("prompt"))
    for bypass in (around, items.select(F.upper("text").alias("prompt")), safe.unionByName(items.groupBy("id").agg(F.max("text").alias("prompt")).select("prompt"))):
        with pytest.raises(ValueError, match="around the masked view"):
            assert_masked(bypass, [raw])
