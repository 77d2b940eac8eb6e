"""Operators against plain-Python brute force on seeded random fixtures.

The fixtures are dense in edge values (NULL, 0, -0.0, repeated keys, a hot
user) and the expected results are computed row by row in Python straight
from the rules, independently of both the Spark code and the SQL oracle.
"""

import datetime as dt
import random
from collections import defaultdict

import pytest

from growthlens.operators import marts, staging, weekly
from growthlens.sources.schemas import META_ADS_RAW

BASE = dt.date(2024, 1, 1)


def _ratio(a, b):
    if a is None or b is None or b == 0:
        return None
    return float(a) / float(b)


def test_meta_cleaner_matches_brute_force(spark):
    rnd = random.Random(11)
    pick = lambda xs: rnd.choice(xs)
    data = []
    for i in range(600):
        data.append(
            (
                f"c{i}",
                "n",
                pick([None, 0.0, -0.0, 1.25, 10.0]),
                pick([None, 0, 5, 100]),
                pick([None, 0, 3]),
                pick([None, 0, 1, 2]),
                pick([None, "2024-01-02", "2024-01-03"]),
                "L",
            )
        )
    out = staging.clean_meta_ads(spark.createDataFrame(data, META_ADS_RAW))
    got = {r["campaign_id"]: r for r in out.collect()}

    def keep(spend, impressions, date):
        if date is None:
            return False
        a = None if spend is None else spend == 0
        b = None if impressions is None else impressions == 0
        both = False if (a is False or b is False) else (None if (a is None or b is None) else True)
        return both is False  # NOT(both) must be TRUE

    want = {}
    for cid, _, spend, impressions, clicks, conversions, date, _ in data:
        if keep(spend, impressions, date):
            want[cid] = (
                float(spend or 0),
                impressions or 0,
                clicks or 0,
                conversions or 0,
                _ratio(clicks, impressions),
                _ratio(conversions, clicks),
            )
    assert set(got) == set(want)
    for cid, (spend, impressions, clicks, conversions, ctr, cr) in want.items():
        r = got[cid]
        assert (float(r["spend_eur"]), r["impressions"], r["clicks"], r["conversions"]) == (
            spend,
            impressions,
            clicks,
            conversions,
        )
        assert r["ctr"] == ctr and r["conversion_rate"] == cr


EVENTS = (
    "event_id string, user_id string, event string, channel string, country string, is_signup boolean, "
    "is_activation boolean, is_purchase boolean, is_churn boolean, event_date date, loaded_at string"
)


def _random_events(seed, n=900):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        user = "hot" if rnd.random() < 0.33 else f"u{rnd.randrange(40)}"
        day = BASE + dt.timedelta(days=rnd.randrange(20))
        event = rnd.choice(["signup", "activation", "purchase", "churned", "page_view", None])
        channel = rnd.choice(["organic", "email", "meta", None])
        rows.append(
            (
                f"e{i}",
                user,
                event,
                channel,
                "IE",
                event == "signup",
                event == "activation",
                event == "purchase",
                event == "churned",
                day,
                "L",
            )
        )
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_retention_matches_brute_force(spark, seed):
    rows = _random_events(seed)
    first = {}
    for r in rows:
        first[r[1]] = min(first.get(r[1], r[9]), r[9])
    active = defaultdict(set)
    for r in rows:
        active[(first[r[1]], (r[9] - first[r[1]]).days)].add(r[1])
    size = {c: len(users) for (c, d), users in active.items() if d == 0}
    want = sorted((c, size[c], d, len(u), len(u) / size[c]) for (c, d), u in active.items())
    out = marts.retention(spark.createDataFrame(rows, EVENTS))
    got = sorted(tuple(r) for r in out.collect())
    assert got == want


def test_activation_and_referral_signups_match_brute_force(spark):
    rows = _random_events(5)
    ev = spark.createDataFrame(rows, EVENTS)
    counts = defaultdict(lambda: [0, 0, 0, 0])
    for r in rows:
        c = counts[(r[9], r[3])]
        for i, flag in enumerate(r[5:9]):
            c[i] += int(flag)
    key = lambda t: (t[0], t[1] is None, t[1] or "")
    want = sorted(
        (
            (d, ch, s, a, p, x, _ratio(a, s), _ratio(p, a), _ratio(x, s))
            for (d, ch), (s, a, p, x) in counts.items()
            if s > 0
        ),
        key=key,
    )
    got = sorted((tuple(r) for r in marts.activation(ev).collect()), key=key)
    assert got == want

    web_rows = [(BASE + dt.timedelta(days=d), "organic", 10 + d, 5, 2) for d in range(0, 20, 2)]
    web = spark.createDataFrame(web_rows, "date date, channel string, sessions bigint, users bigint, new_users bigint")
    search = spark.createDataFrame([], "date date, impressions bigint, clicks bigint, avg_position double")
    signups = defaultdict(set)
    for r in rows:
        if r[5]:
            signups[r[9]].add(r[1])
    got = {r["date"]: r["total_new_signups"] for r in marts.referral(web, search, ev).collect()}
    assert got == {d: len(signups.get(d, ())) for d, *_ in web_rows}


def test_weekly_delta_matches_brute_force(spark):
    rnd = random.Random(3)
    acq_rows = []
    for d in range(0, 60):
        if rnd.random() < 0.2:
            continue  # missing days, and whole missing weeks
        day = BASE + dt.timedelta(days=d)
        conv = rnd.choice([0, 1, 5])
        spend = round(rnd.uniform(1, 100), 2)
        acq_rows.append((day, "meta", spend, conv, _ratio(spend, conv), rnd.uniform(0, 3), rnd.uniform(0, 0.1)))
    acq = spark.createDataFrame(
        acq_rows, "date date, channel string, total_spend double, total_conversions bigint, cac double, roas double, ctr double"
    )
    act = spark.createDataFrame([], "date date, channel string, total_signups bigint, activation_rate double, churn_rate double")
    ref = spark.createDataFrame([], "date date, organic_sessions bigint, organic_traffic_share double, k_factor_estimate double")

    from decimal import ROUND_HALF_UP, Decimal

    def sql_round(x, n):
        return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-n), rounding=ROUND_HALF_UP))

    weeks = defaultdict(list)
    for r in acq_rows:
        weeks[r[0] - dt.timedelta(days=r[0].weekday())].append(r)

    def kpis(ws):
        rs = weeks.get(ws, [])
        cacs = [r[4] for r in rs if r[4] is not None]
        return {
            "avg_cac": sql_round(sum(cacs) / len(cacs), 2) if cacs else 0.0,
            "total_spend": float(sum(Decimal(repr(r[2])) for r in rs)) if rs else 0.0,
            "total_conversions": sum(r[3] for r in rs),
        }

    def change(new, old):
        return 0 if old == 0 else round(((new - old) / old) * 100, 1)

    got = {r["week_start"]: r for r in weekly.weekly_delta(acq, act, ref).collect()}
    assert set(got) == set(weeks)
    for ws in weeks:
        now, before = kpis(ws), kpis(ws - dt.timedelta(days=7))
        assert got[ws]["cac_change"] == pytest.approx(change(now["avg_cac"], before["avg_cac"]), abs=0.1)
        assert got[ws]["spend_change"] == pytest.approx(change(now["total_spend"], before["total_spend"]), abs=0.1)
        assert got[ws]["conversions_change"] == change(now["total_conversions"], before["total_conversions"])
