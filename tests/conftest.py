import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fleetlens.schemas import POSITIONS  # noqa: E402
from fleetlens.session import build_session, ensure_checkpoint_dir  # noqa: E402

SMALL = "/root/testdata/sf0.001"
START = datetime(2024, 3, 1, 8, 0, 0)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def reports(spark):
    """Build positions from short dicts: ``at`` seconds after the start, ``p`` vehicle, ``km`` north of the origin."""

    def build(rows):
        data = []
        for i, row in enumerate(rows):
            km = row.get("km", 0.0)
            data.append((
                row.get("id", i), row.get("c", "627J-10"), 627, row.get("sl", 1), row.get("lt0", "TERM"),
                row.get("lt1", "ORIG"), 10, row["p"], True, 0, "2024-03-01 08:00:00",
                row.get("py", -23.5 + km / 111.19492664455873), row.get("px", -46.6),
                START + timedelta(seconds=row["at"]),
            ))
        return spark.createDataFrame(data, POSITIONS)

    return build


def rows_of(df):
    """All rows as a sorted list of plain tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
