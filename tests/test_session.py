"""Tables that are written on the way to a result, and when they go."""

import uuid
from pathlib import Path

from headwind.session import materialize, noting, remove, settled, shared_root


def there(spark, purpose):
    return {p.name for p in Path(shared_root(spark), "headwind").glob(f"{purpose}-*")}


def test_settled_keeps_the_result_only(spark):
    way, result = (f"{name}{uuid.uuid4().hex}" for name in ("way", "result"))

    def make():
        first = materialize(spark.range(5), way)
        second = materialize(first.selectExpr("id * 2 AS id"), way)
        return first.join(second, "id")

    with noting() as made:
        found = settled(spark, make, result)
    assert sorted(r.id for r in found.collect()) == [0, 2, 4]
    assert there(spark, way) == set() and len(made) == 1
    remove(spark, made)
    assert there(spark, result) == set()


def test_noting_inside_noting_sees_its_own_folders(spark):
    name = f"noted{uuid.uuid4().hex}"
    with noting() as outer:
        materialize(spark.range(1), name)
        with noting() as inner:
            materialize(spark.range(1), name)
        materialize(spark.range(1), name)
    assert len(outer) == 2 and len(inner) == 1 and len(there(spark, name)) == 3
    remove(spark, outer + inner)
    with noting() as rest:
        materialize(spark.range(1), name)
    assert len(there(spark, name)) == 1
    remove(spark, rest)
