import random
from collections import defaultdict
from datetime import datetime, timezone

import pytest

from sonotheca.operators import dispatch as d

BASE = 1704067200
OPEN = "account STRING, item BIGINT, audio_seconds DOUBLE, ready_ts TIMESTAMP, action STRING"
CALLS = "account STRING, ts TIMESTAMP, audio_seconds DOUBLE"


def at(seconds):
    return datetime.fromtimestamp(BASE + seconds, timezone.utc)


def fits(sent, second, audio, quotas):
    """Whether one more item at ``second`` keeps every window that ends there within its limit."""
    for width, limit, is_audio in quotas.windows():
        used = sum(a if is_audio else 1 for s, a in sent if second - width < s <= second)
        if used + (audio if is_audio else 1) > limit:
            return False
    return True


def brute(open_, calls, quotas, days):
    """Second by second, first come first served."""
    out, queues, sent = {}, defaultdict(list), defaultdict(list)
    for account, when, audio in calls:
        sent[account].append((when, round((audio or 0) * 1000)))
    for account, item, audio, ready, action in open_:
        ms = round((audio or 0) * 1000)
        if action == "give_up":
            out[item] = "give_up", None
        elif ms > round(min(quotas.audio_hour, quotas.audio_day) * 1000):
            out[item] = "too_long", None
        else:
            queues[account].append((-(-ready // 1), item, ms))
    for account, queue in queues.items():
        clock = int(max((s for s, _ in sent[account]), default=-(10 ** 9)))
        for place, (ready, item, ms) in enumerate(sorted(queue)):
            if place >= days * quotas.requests_day:
                out[item] = "later", None
                continue
            clock = int(max(clock, ready))
            while not fits(sent[account], clock, ms, quotas):
                clock += 1
            sent[account].append((clock, ms))
            out[item] = "planned", clock
    return out


def planned(spark, open_, calls, quotas, days=1):
    rows = spark.createDataFrame([(a, i, x, None if r is None else at(r), y) for a, i, x, r, y in open_], OPEN)
    made = spark.createDataFrame([(a, at(s), x) for a, s, x in calls], CALLS)
    found = d.dispatch_plan(rows, made, days, quotas).collect()
    assert len(found) == len(open_)
    return {r["item"]: (r["state"], r["send_at"] and int(r["send_at"].replace(tzinfo=timezone.utc).timestamp()) - BASE) for r in found}


@pytest.mark.parametrize("seed", range(2))
def test_plans_against_a_replay_second_by_second(spark, seed):
    rnd = random.Random(seed)
    quotas = d.Quotas(requests_minute=3, requests_day=40, audio_hour=600.0, audio_day=2000.0)
    open_ = [(rnd.choice(["a", "a", "b", None]), i, rnd.choice([0.0, 10.5, 200.0, 599.0, None]), float(rnd.randrange(3000)) + rnd.choice([0, 0.25]),
              rnd.choice(["first", "retry"])) for i in range(60)]
    open_ += [("a", 100, 601.0, 0.0, "first"), ("b", 101, 1.0, 0.0, "give_up")]
    calls = [(rnd.choice(["a", "b", "other"]), rnd.randrange(-90_000, 1000), rnd.choice([0.0, 100.0])) for _ in range(40)]
    assert planned(spark, open_, calls, quotas) == brute(open_, calls, quotas, 1)


def test_more_items_than_the_days_take_and_no_calls_yet(spark):
    quotas = d.Quotas(requests_minute=2, requests_day=5, audio_hour=100.0, audio_day=100.0)
    open_ = [("hot", i, 0.0, 0.0, "first") for i in range(30)]
    got = planned(spark, open_, [], quotas, days=2)
    assert [got[i][1] for i in range(10)] == [0, 0, 60, 60, 120, 86400, 86400, 86460, 86460, 86520]
    assert {got[i] for i in range(10, 30)} == {("later", None)}
    with pytest.raises(ValueError):
        d.dispatch_plan(spark.createDataFrame([], OPEN), spark.createDataFrame([], CALLS), quotas=d.Quotas(requests_minute=0))


def test_what_is_open_and_when(spark):
    items = spark.createDataFrame([(i, "a", 1.0, at(100)) for i in range(6)], "item BIGINT, account STRING, audio_seconds DOUBLE, queued_ts TIMESTAMP")
    tried = [(1, "transcription", 0, "boom", at(200)), (2, "transcription", 1, "HTTP 429", at(50)), (2, "transcription", 0, "boom", at(300)),
             (3, "transcription", 2, "boom", at(10)), (4, "transcription", 0, "boom", at(0)), (4, "embedding", 0, "503", at(90))]
    attempts = spark.createDataFrame(tried, "item BIGINT, service STRING, attempt INT, error STRING, ts TIMESTAMP")
    done = spark.createDataFrame([(0, None), (1, "failed")], "item BIGINT, error STRING")
    got = {r["item"]: (r["action"], int(r["ready_ts"].replace(tzinfo=timezone.utc).timestamp()) - BASE) for r in d.open_items(items, attempts, done).collect()}
    assert got == {1: ("retry", 205), 2: ("retry", 170), 3: ("give_up", 100), 4: ("retry", 110), 5: ("first", 100)}


def test_empty_tables(spark):
    assert d.dispatch_plan(spark.createDataFrame([], OPEN), spark.createDataFrame([], CALLS)).count() == 0
