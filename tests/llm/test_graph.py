"""Connected components in rounds."""

import random

from presslens.llm import graph
from presslens.shared import materialise


def test_rounds_of_few_links_take_few_tasks(spark, monkeypatch):
    """Pipeline on check_h: every round of the Jaccard join's components ran and recorded 211 tasks a stage, however few the links."""
    tasks = []

    def noted(df, name, **options):
        tasks.append(df.rdd.getNumPartitions())
        return materialise(df, name, **options)

    monkeypatch.setattr(graph, "materialise", noted)
    draw = random.Random(5)
    links = [(draw.randrange(400), draw.randrange(400)) for _ in range(300)]
    forest = graph.Forest(400)
    for a, b in links:
        forest.join(a, b)
    want = {}
    for x in range(400):
        want.setdefault(forest.find(x), []).append(x)
    held = {"spark.sql.shuffle.partitions": "48", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {x: group[0] for group in want.values() if len(group) > 1 for x in group}
    assert len(tasks) > 2 and max(tasks[1:]) <= graph.LEAST_TASKS
