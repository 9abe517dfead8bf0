import random

from dwellspark.llm.components import components


def test_chains_stars_and_loops(spark):
    rng = random.Random(4)
    chain = list(range(100, 160))
    rng.shuffle(chain)
    links = list(zip(chain, chain[1:], strict=False)) + [(1, 1), (7, 5), (5, 7), (5, 6), *((500, x) for x in range(501, 540))]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{x: 100 for x in chain}, 5: 5, 6: 5, 7: 5, **{x: 500 for x in range(500, 540)}}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
