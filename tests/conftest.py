from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from newsloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def rows():
    """Three records as a user holds them in memory: two of one day, one without a summary."""
    names = "id title url image_url news_site summary published_at updated_at featured launches events".split()
    values = [
        ("41", 'Lander tilts, "upright" later', "https://alpha.example/l/41", "", "Alpha",
         "The lander of NASA tilted near the Moon; lander upright again.", "2031-05-04", "2031-05-06", True,
         '[{"launch_id": "a1"}]', "[]"),
        ("42", "Dust", "https://beta.example/d", "https://beta.example/d.png", "Beta",
         "Dust storm on Mars delays a rover.", "2031-05-04", "2031-05-04", False, "[]", '[{"event_id": 3}, {"event_id": 9}]'),
        ("7", "Nothing yet", None, None, "Alpha", "", "2030-12-31", "2031-01-01", None, "[]", "[]"),
    ]
    return [dict(zip(names, v)) for v in values]


def tuples(df, *columns):
    """Rows as sorted tuples."""
    frame = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in frame.collect()), key=repr)
