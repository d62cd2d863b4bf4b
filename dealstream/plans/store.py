"""The stored tables that the report queries read: decision log and gold facts of a set of inputs.

They are built once an application and input (a change of a file builds them anew)
under the shared folder and read as tables from then on, as a warehouse's reports
read its facts: the log when a query first reads the log or the facts, the facts when
one first reads them. The keys of the decision core and the full rebuilds don't use them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import decide as D
from ..operators import star as ST
from ..operators.gold import Gold
from ..session import configure, unique_dir
from ..sources import files
from ..sources import ingest as I
from ..sources import tables as T

BOUNDS = ST.DateBounds(T.DATE_DIM_START, T.DATE_DIM_END)
INPUTS = ("lineitem", "orders", "customer", "nation", "part", "supplier")

_BUILT: dict[tuple, Gold] = {}
_MERGED: set[tuple] = set()


def _built(spark: SparkSession, sf_dir: str) -> tuple[tuple, Gold]:
    """The decision log of the inputs in ``sf_dir``, and its place."""
    configure(spark)
    changed = tuple(files.newest_change(spark, f"{sf_dir.rstrip('/')}/{t}.parquet") for t in INPUTS)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), changed)
    if key not in _BUILT:
        root = unique_dir(spark, "gold")
        decided = D.evaluate_replay(T.deal_deliveries(spark, sf_dir), T.AS_OF, by_trade=True)
        I.append(decided, f"{root}/decisions", 0)
        _BUILT[key] = Gold(spark, root, f"{root}/decisions", BOUNDS, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    return key, _BUILT[key]


def store(spark: SparkSession, sf_dir: str) -> Gold:
    """Decision log and gold facts of the inputs in ``sf_dir``."""
    key, gold = _built(spark, sf_dir)
    if key not in _MERGED:
        gold.refresh()
        _MERGED.add(key)
    return gold


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored decision log; who reads no facts waits for none."""
    return I.read_appended(spark, _built(spark, sf_dir)[1].decisions)
