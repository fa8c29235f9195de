import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from clickloom import schema as S  # noqa: E402
from clickloom.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[*]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="clickloom-test-")


def at(clock: str, day: int = 1) -> dt.datetime:
    return dt.datetime.combine(dt.date(2026, 1, day), dt.time.fromisoformat(clock))


def make_events(spark, rows):
    """Contract events from (session, user, time, name[, extra dict]) tuples."""
    out = []
    for i, (session, user, time, name, *extra) in enumerate(rows):
        row = {f.name: None for f in S.EVENT_SCHEMA.fields}
        row.update(
            event_id=f"e{i:05d}",
            user_id=user,
            session_id=session,
            event_timestamp=at(time) if isinstance(time, str) else time,
            event_name=name,
            experiment_id="EXP-001",
            variant="control",
            device_type="mobile",
            traffic_source="direct",
        )
        row.update(extra[0] if extra else {})
        out.append(tuple(row[f.name] for f in S.EVENT_SCHEMA.fields))
    return spark.createDataFrame(out, S.EVENT_SCHEMA)


def rows(df, *columns):
    """Sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
