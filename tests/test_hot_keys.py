"""One user / receiver / post holding a third of all rows: results stay exact and
every aggregate combines map-side before its shuffle (the hot key never travels
as raw rows to one task)."""

import io
import random
from contextlib import redirect_stdout
from datetime import date, datetime

from pyspark.sql import functions as F

from pulsekit.operators import audience, etl, experiment as X
from tests.frames import feed_df, feed_row, msg_df, msg_row

AS_OF = date(2024, 1, 31)


def _plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _skewed(spark):
    rng = random.Random(3)
    feed, msgs = [], []
    for i in range(3000):
        user = 1 if i % 3 == 0 else 2 + rng.randint(0, 400)  # user 1: a third of the rows
        post = 7 if i % 3 == 1 else rng.randint(0, 50)       # post 7: a third of the rows
        t = datetime(2024, 1, 24 + i % 7, rng.randint(0, 23), rng.randint(0, 59))
        feed.append(feed_row(user, "like" if rng.random() < 0.2 else "view", t, post=post, group=1 + user % 2))
        receiver = 1 if i % 3 == 2 else rng.randint(2, 300)  # receiver 1: a third of the messages
        msgs.append(msg_row(2 + rng.randint(0, 400), receiver, datetime(2024, 1, 30, rng.randint(0, 23))))
    return feed, msgs


def test_hot_user_receiver_and_post(spark):
    feed_rows, msg_rows = _skewed(spark)
    feed = feed_df(spark, feed_rows).repartition(8)
    msgs = msg_df(spark, msg_rows).repartition(8)

    um = X.user_ctr(feed, date(2024, 1, 24), date(2024, 1, 30), [1, 2])
    hot = um.where("user_id = 1").collect()[0]
    assert hot["likes"] + hot["views"] == 1000
    assert hot["likes"] == sum(1 for r in feed_rows if r[0] == 1 and r[2] == "like")
    plan = _plan(um)
    assert plan.index("partial_count") > plan.index("Exchange")  # partial aggregate sits below the exchange

    received = etl.messages_received_daily(msgs, AS_OF).where("user_id = 1").collect()[0]
    assert received["messages_received"] == 1000
    assert received["users_received"] == len({r[0] for r in msg_rows if r[1] == 1})
    plan = _plan(etl.messages_received_daily(msgs, AS_OF))
    # distinct count: first shuffled on (receiver, sender), so the hot receiver is spread
    assert "hashpartitioning(user_id" in plan or "hashpartitioning(reciever_id" in plan

    posts = {r["date"]: r["posts"] for r in audience.new_posts_daily(feed, AS_OF).collect()}
    first_seen = {}
    for r in feed_rows:
        first_seen[r[1]] = min(first_seen.get(r[1], r[3].date()), r[3].date())
    expected = {}
    for d in first_seen.values():
        expected[d] = expected.get(d, 0) + 1
    assert posts == expected
