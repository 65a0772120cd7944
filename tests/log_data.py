"""Small logs for the tests: rows written by hand and random ones."""

from __future__ import annotations

import random
from datetime import datetime, timezone

from stayflow.schema import EVENT_SCHEMA, PAGES

DAY_MS = 86_400_000


def ms(day: str, hour: int = 12, milli: int = 0) -> int:
    moment = datetime.fromisoformat(day).replace(tzinfo=timezone.utc)
    return int(moment.timestamp() * 1000) + hour * 3_600_000 + milli


def event(user, day, page="NextSong", level="free", hour=12, registered="2018-09-01", **more) -> dict:
    row = {f.name: None for f in EVENT_SCHEMA.fields}
    row.update(
        userId=user,
        ts=ms(day, hour) if isinstance(day, str) else day,
        page=page,
        level=level,
        registration=ms(registered, 0) if registered else None,
    )
    if page == "NextSong":
        row.update(song="song", artist="artist", length=100.0)
    row.update(more)
    return row


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[f.name] for f in EVENT_SCHEMA.fields) for r in rows], EVENT_SCHEMA)


def random_rows(seed: int, users: int = 25, events: int = 1200, hot: float = 0.33) -> list[dict]:
    """Random events over 40 days; one user has about a third of them, some values are missing."""
    rng = random.Random(seed)
    start = ms("2018-10-01", 0)
    rows = []
    for _ in range(events):
        who = "hot" if rng.random() < hot else f"u{rng.randrange(users)}"
        page = "NextSong" if rng.random() < 0.6 else rng.choice(PAGES)
        row = event(
            who,
            start + rng.randrange(40 * DAY_MS),
            page,
            rng.choice(["free", "paid"]),
            registered=rng.choice([None, "2018-09-20", "2018-10-05", "2018-11-20"]),
        )
        row["song"] = rng.choice([None, *[f"s{i}" for i in range(30)]])
        row["artist"] = rng.choice([None, *[f"a{i}" for i in range(12)]])
        row["length"] = rng.choice([None, float(rng.randrange(1, 400))])
        rows.append(row)
    return rows
