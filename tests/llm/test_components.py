import random
import uuid

import pytest

from weir.llm.common import Stash
from weir.llm.components import HELD, components


def brute(links):
    least = {x: x for uv in links for x in uv}
    while any(least[u] != least[v] for u, v in links):
        for u, v in links:
            least[u] = least[v] = min(least[u], least[v])
    return sorted((x, c) for x, c in least.items())


def graph(seed):
    rnd = random.Random(seed)
    names = rnd.sample(range(1 << 40), 400)
    chain = [(names[i], names[i + 1]) for i in range(60)]
    hub = [(names[100], names[i]) for i in range(101, 160)]
    loose = [(rnd.choice(names[200:]), rnd.choice(names[200:])) for _ in range(110)]
    links = chain + hub + loose + hub[:5] + [(v, u) for u, v in chain[:5]]
    rnd.shuffle(links)
    return [uv for uv in links if uv[0] != uv[1]]


@pytest.mark.parametrize("held", [0, 7, 100, HELD])
def test_each_node_gets_the_least_it_reaches(spark, held):
    links = graph(3)
    df = spark.createDataFrame([*links, (5, 5)], "u long, v long").repartition(4)
    assert sorted(tuple(r) for r in components(df, Stash(spark, "test"), held).collect()) == brute(links)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "u long, v long"), Stash(spark, "test"), HELD).collect() == []


def test_few_links_take_few_tasks(spark):
    """However many partitions a shuffle has, links that one task can hold are not dealt over them."""
    df = Stash(spark, "test").put(spark.createDataFrame(graph(4), "u long, v long").coalesce(2))
    before, group = spark.conf.get("spark.sql.shuffle.partitions"), uuid.uuid4().hex
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    spark.sparkContext.setJobGroup(group, "components")
    try:
        assert components(df, Stash(spark, "test"), HELD).count() > 200
        told = spark.sparkContext.statusTracker()
        stages = {s for j in told.getJobIdsForGroup(group) for s in told.getJobInfo(j).stageIds}
        assert stages and sum(told.getStageInfo(s).numTasks for s in stages if told.getStageInfo(s)) < 50
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_near_duplicates_contract_links(spark, monkeypatch):
    from weir.llm import minhash

    told = []
    monkeypatch.setattr(minhash, "components", lambda links, stash, *held: told.append(held) or components(links, stash, *held))
    docs = spark.createDataFrame([(i, "a b c d e f g h i j k l %s" % ("m" * (i % 2))) for i in range(6)], "doc_id long, text string")
    assert {r.component_id for r in minhash.near_duplicates(docs, size=2).collect()} == {0}
    assert told and all(h == (HELD,) for h in told)


def test_open_lists_are_joined_with_sizes_once(spark, monkeypatch):
    from weir.llm import minhash

    joins, join = [], type(spark.range(1)).join
    monkeypatch.setattr(minhash, "SHORT", 1)
    monkeypatch.setattr(type(spark.range(1)), "join", lambda self, other, on=None, how=None: joins.append(1 if on == "id" and "home" in self.columns and how is None else 0) or join(self, other, on, how))
    rows = [(i, " ".join(f"w{j if j % 4 or i % 3 == 0 else (i % 3) * 1000 + j}" for j in range(40)) + f" x{i}") for i in range(12)]
    minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()
    assert sum(joins) == 1
