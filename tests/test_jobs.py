"""Restartable steps and durable dimension members."""

import pytest
from pyspark.sql import functions as F

from itinera.jobs import Job, reserve_keys


class Killed(Exception):
    pass


class Flaky(Job):
    """Dies when the given row of the step table is about to be written."""

    die_at = None

    def log(self, step, status, *args, **kwargs):
        if self.die_at == (step, status):
            raise Killed
        super().log(step, status, *args, **kwargs)


def load(job, spark, built):
    def rows(name, make):
        def build():
            built.append(name)
            return make()
        return job.step(name, build)

    one = rows("one", lambda: spark.range(10).withColumn("x", F.col("id") * 2))
    two = rows("two", lambda: one.where("x > 5"))
    out = job.publish("fact", "two", "batch")
    job.finish()
    return one, two, out


@pytest.mark.parametrize("at", [("one", "started"), ("one", "committed"), ("two", "started"), ("two", "committed"),
                                ("publish fact", "started"), ("publish fact", "committed"), ("", "finished")])
def test_resumes_behind_the_last_marker(spark, tmp_path, at):
    root, built = str(tmp_path), []
    first = Flaky(spark, root, "j", 7)
    first.die_at = at
    with pytest.raises(Killed):
        load(first, spark, built)
    marked = [e.step for e in first.events().where("status = 'committed'").collect()]
    again = Job(spark, root, "j", 7)
    assert again.generation == 1
    before = list(built)
    _, _, out = load(again, spark, built)
    assert not set(built[len(before):]) & set(marked)          # what had a marker was read back
    assert sorted(r.x for r in out.collect()) == [6, 8, 10, 12, 14, 16, 18]
    statuses = [(e.step, e.status) for e in again.events().orderBy("seq").collect()]
    assert statuses[-1] == ("", "finished") and statuses.count(("two", "committed")) == 1
    counts = {e.step: e.n_rows for e in again.events().where("status = 'committed' and n_rows is not null").collect()}
    assert counts == {"one": 10, "two": 7}
    assert Job(spark, root, "j", 7).generation == 2 and Job(spark, root, "j", 8).generation == 1


def test_failed_step_is_logged_and_built_again(spark, tmp_path):
    job = Job(spark, str(tmp_path), "j", 1)
    with pytest.raises(ZeroDivisionError):
        job.step("one", lambda: spark.range(1 // 0))
    assert [(e.status, e.note) for e in job.events().orderBy("seq").collect()] == [("started", None), ("failed", "ZeroDivisionError")]
    assert Job(spark, str(tmp_path), "j", 1).step("one", lambda: spark.range(3)).count() == 3


def test_empty_batch_replaces_its_rows(spark, tmp_path):
    for n, want in ((3, 3), (0, 0), (2, 2)):
        job = Job(spark, str(tmp_path), "j", 1)
        job.step("one", lambda n=n: spark.range(n))
        assert job.publish("fact", "one", "batch").count() == want
        job.finish()


def dimension(spark, job, names):
    seed = spark.createDataFrame([(4, "a", "A")], "key int, name string, upper string")
    cand = lambda: spark.createDataFrame([(n,) for n in names], "name string")
    rows = job.members("letter", cand, ["name"], "key", seed, lambda d: d.withColumn("upper", F.upper("name"))).collect()
    assert len({r.key for r in rows}) == len(rows) == len({r.name for r in rows})
    assert all(r.upper == (r.name and r.name.upper()) for r in rows)
    return {r.name: r.key for r in rows}


def test_members_keep_one_meaning_over_batches(spark, tmp_path):
    root, jobs = str(tmp_path), []
    for batch, names in ((1, ["b", "a", None, "b"]), (2, ["c", "b"]), (3, ["a"]), (1, ["d"])):
        jobs.append(Job(spark, root, "j", batch))
        now = dimension(spark, jobs[-1], names)
        jobs[-1].finish()
        assert set(names) <= set(now)
        if batch > 1 or len(jobs) > 3:
            assert before.items() <= now.items()               # noqa: F821
        before = now                                           # noqa: F841
    assert set(now) == {"a", "b", "c", "d", None} and now["a"] == 4


@pytest.mark.parametrize("at", [("letter candidates", "committed"), ("letter members", "started"), ("letter members", "committed"),
                                ("store letter", "committed")])
def test_members_survive_a_kill_and_another_batch(spark, tmp_path, at):
    root = str(tmp_path)
    first = Flaky(spark, root, "j", 1)
    first.die_at = at
    with pytest.raises(Killed):
        dimension(spark, first, ["x", "y"])
    other = dimension(spark, Job(spark, root, "j", 2), ["z"])   # another batch in between
    now = dimension(spark, Job(spark, root, "j", 1), ["x", "y"])
    assert other.items() <= now.items() and set(now) == {"a", "x", "y", "z"}
    assert dimension(spark, Job(spark, root, "j", 3), ["y", "x"]) == now


def test_reserved_ranges(spark, tmp_path):
    path = str(tmp_path / "ranges")
    assert reserve_keys(spark, path, "a", 5, 10) == 10
    assert reserve_keys(spark, path, "a", 5, 10) == 10          # the same owner again
    assert reserve_keys(spark, path, "b", 3, 10) == 15 and reserve_keys(spark, path, "c", 0, 40) == 40
    clash = spark.createDataFrame([("d", 15, 9, "t")], "owner string, first_key long, n long, token string")
    clash.write.mode("append").parquet(path)                    # written at the same time as b's
    assert reserve_keys(spark, path, "b", 3, 10) == 24          # b gives its range up


def test_members_must_fit_their_key(spark, tmp_path):
    seed = spark.createDataFrame([(2 ** 15 - 1, "a")], "key short, name string")
    with pytest.raises(OverflowError):
        Job(spark, str(tmp_path), "j", 1).members("d", lambda: spark.createDataFrame([("b",)], "name string"), ["name"], "key", seed)
