import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidewatch import schema
from tidewatch.session import build_session

AS_OF = datetime(2024, 1, 31, 12)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", spark__master="local[4]", spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_events(spark):
    """Events from (customer_id, timestamp, event_type, amount) tuples."""

    def make(*rows):
        # Text timestamps: naive datetimes would be read in the machine's time zone.
        data = [(customer, None if moment is None else str(moment), kind,
                 {} if amount is None else {"amount": amount}, "1.0")
                for customer, moment, kind, amount in rows]
        frame = spark.createDataFrame(
            data, "customer_id string, timestamp string, event_type string, "
                  "event_data map<string,string>, schema_version string")
        return frame.withColumn("timestamp", frame["timestamp"].cast("timestamp"))

    return make


@pytest.fixture
def sample(make_events):
    def ago(days):
        return AS_OF - timedelta(days=days)

    return make_events(
        ("customer_1", ago(5), "purchase", "100"),
        ("customer_1", ago(3), "page_view", None),
        ("customer_1", ago(1), "support_ticket", None),
        ("customer_2", ago(10), "purchase", "50"),
        ("customer_2", ago(2), "page_view", None))


@pytest.fixture
def by_customer():
    def collect(frame):
        return {row["customer_id"]: row for row in frame.collect()}

    return collect


def plan_of(frame):
    """The physical plan as text, complete."""
    frame.sparkSession.conf.set("spark.sql.maxPlanStringLength", str(10 ** 8))
    frame.sparkSession.conf.set("spark.sql.debug.maxToStringFields", "1000")
    frame.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return frame._jdf.queryExecution().executedPlan().toString()


def operators(frame, name):
    """How many operators of the physical plan start with `name`."""
    lines = (line.lstrip(" :+-*(0123456789)") for line in plan_of(frame).splitlines())
    return sum(line.startswith(name) for line in lines)


def sum_of_scans(frame):
    """Rows that the file scans of a collected frame have read, each reused part once."""
    seen, total, todo = set(), 0, [frame._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "ReusedExchangeExec" or node.id() in seen:
            continue
        seen.add(node.id())
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        if kind == "FileSourceScanExec":
            total += node.metrics().apply("numOutputRows").value()
        for listed in (node.children(), node.subqueries()):
            todo += [listed.apply(i) for i in range(listed.size())]
    return total
