"""Sessions and the report against a plain Python version, with sessions across bucket edges."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from millrace.sources.web_report import web_report

START = datetime(2024, 1, 1)


def make_events(seed, users=6, size=400):
    rng = random.Random(seed)
    events = []
    for user in range(users):
        # One user makes a third of all events; some users pause for hours or exactly half an hour.
        for _ in range(size * 3 if user == 0 else size // 4):
            second = rng.choice([rng.randrange(3 * 86400), 1800 * rng.randrange(150), 3600 * rng.randrange(70)])
            kind = rng.choice(["view", "view", "click", "purchase"])
            moment = START + timedelta(seconds=second, microseconds=rng.randrange(3) * 250_000)
            events.append((moment, user if user != 5 else None, kind,
                           rng.choice(["/a", "/b"]), kind == "view", kind == "purchase"))
    return events


def python_report(events, gap=1800, engaged_after=10):
    by_user = defaultdict(list)
    for e in events:
        by_user[e[1]].append(e)
    rows = defaultdict(lambda: dict(users=set(), new=set(), sessions=set(), conversions=0, engagement=0, events=0, views=0))
    lengths = {}
    for e in by_user.pop(None, []):  # nobody's events are counted, and nothing else
        row = rows[(e[0].date(), e[2], e[3])]
        row["conversions"] += e[5]
        row["views"] += e[4]
        row["events"] += 1
    for user, own in by_user.items():
        own.sort(key=lambda e: (e[0], e[2], e[3]))
        session, members = None, defaultdict(list)
        for i, e in enumerate(own):
            if i == 0 or (e[0] - own[i - 1][0]).total_seconds() >= gap:
                session = (user, i)
            members[session].append(e)
            row = rows[(e[0].date(), e[2], e[3])]
            row["users"].add(user)
            if e[0] == own[0][0]:
                row["new"].add(user)
            row["sessions"].add(session)
            row["conversions"] += e[5]
            row["views"] += e[4]
            row["events"] += 1
            if i + 1 < len(own) and (own[i + 1][0] - e[0]).total_seconds() < gap:
                row["engagement"] += (own[i + 1][0] - e[0]) // timedelta(microseconds=1)
        for key, ms in members.items():
            length = (ms[-1][0] - ms[0][0]) // timedelta(microseconds=1)
            engaged = length > engaged_after * 1_000_000 or any(m[5] for m in ms) or sum(m[4] for m in ms) >= 2
            lengths[key] = (length, engaged)
    result = {}
    for key, row in rows.items():
        n = len(row["sessions"])
        engaged = sum(lengths[s][1] for s in row["sessions"])
        result[key] = (
            len(row["users"]), n, len(row["new"]),
            *((sum(lengths[s][0] for s in row["sessions"]) / n / 1_000_000, 1 - engaged / n, engaged / n) if n else (None,) * 3),
            row["conversions"], row["engagement"] / 1_000_000, row["events"], row["views"],
        )
    return result


@pytest.mark.parametrize("bucket", [3600, 600, 60, 86400 * 30])
def test_against_python(spark, bucket):
    events = make_events(bucket)
    events.append((START - timedelta(days=9), None, "view", "/c", True, False))
    df = spark.createDataFrame(
        events, "ts timestamp_ntz, user_id int, pageTitle string, pagePath string, is_view boolean, is_conversion boolean"
    ).repartition(5)
    report = web_report(df, bucket_seconds=bucket)
    found = {(r.date, r.pageTitle, r.pagePath): tuple(r)[3:] for r in report.collect()}
    expected = python_report(events)
    assert found.keys() == expected.keys()
    for key, row in expected.items():
        assert found[key] == (row if None in row else pytest.approx(row)), key
