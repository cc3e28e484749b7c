"""Property tests: any split of the messages into batches gives the batch answer."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from chargepulse.plans import notify as N, topup as T
from chargepulse.plans.catalog import QUERIES, notify_clean, topup_clean
from chargepulse.plans.rollup import rollup
from chargepulse.streaming.sinks import BATCH_COL

from conftest import SF001

SETTINGS = settings(max_examples=4, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def _batched(clean, seed, batches):
    return clean.withColumn(BATCH_COL, F.pmod(F.xxhash64(F.lit(seed), *clean.columns), F.lit(batches)))


def _union_of_batches(clean, partials, batches):
    parts = [partials(clean.where(F.col(BATCH_COL) == b).drop(BATCH_COL)) for b in range(batches)]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union


@SETTINGS
@given(seed=st.integers(0, 2**31 - 1), batches=st.integers(1, 7))
def test_notify_partials_any_split(spark, seed, batches):
    from chargepulse.streaming.apps import _with_times, notify_partials
    clean = _batched(notify_clean(spark, SF001), seed, batches)
    union = _with_times(_union_of_batches(clean, notify_partials, batches))
    for kpi in (N.daily_totals, N.minute_orders, N.province_hour_failures, N.top10_province,
                N.hourly_totals):
        assert rows(kpi(union)) == rows(kpi(notify_clean(spark, SF001)))


@SETTINGS
@given(seed=st.integers(0, 2**31 - 1), batches=st.integers(1, 7))
def test_topup_partials_any_split(spark, seed, batches):
    from chargepulse.streaming.apps import topup_partials
    clean = _batched(topup_clean(spark, SF001), seed, batches)
    union = _union_of_batches(clean, topup_partials, batches)
    assert rows(T.month_phone_avg(union)) == rows(QUERIES["month_phone_avg"](spark, SF001))
    assert rows(T.phone_mean_monthly(union)) == rows(QUERIES["phone_mean_monthly"](spark, SF001))
    assert rows(T.topup_daily_money(union)) == rows(QUERIES["topup_daily_money"](spark, SF001))


@SETTINGS
@given(seed=st.integers(0, 2**31 - 1))
def test_success_plus_failures_is_orders(spark, seed):
    clean = notify_clean(spark, SF001).where(F.pmod(F.xxhash64(F.lit(seed), "request_id"), F.lit(3)) != 0)
    fails = N.province_hour_failures(clean).groupBy("province").agg(F.sum("failures").alias("f"))
    tot = rollup(clean, ["province"], ["success"])
    bad = tot.join(fails, "province").where(F.col("orders") != F.col("success") + F.col("f"))
    assert bad.count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1970, 2099), st.integers(0, 13), st.integers(0, 32),
                          st.integers(0, 24), st.integers(0, 60), st.integers(0, 60),
                          st.integers(0, 999)), min_size=20, max_size=120))
def test_time_digits_match_the_calendar(spark, parts):
    """17 digits parse exactly when they name a real UTC instant, to the millisecond."""
    from datetime import datetime, timedelta, timezone

    from chargepulse.functions.times import digits_to_ts

    texts = ["%04d%02d%02d%02d%02d%02d%03d" % p for p in parts]
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)

    def expect(p):
        try:   # exact integer milliseconds (float seconds * 1000 can be off by one)
            return (datetime(*p[:6], p[6] * 1000, tzinfo=timezone.utc) - epoch) // timedelta(milliseconds=1)
        except ValueError:
            return None

    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r.ms for r in df.select(F.unix_millis(digits_to_ts("s")).alias("ms")).collect()]
    assert got == [expect(p) for p in parts]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1990, 2030), st.integers(1, 12), st.integers(1990, 2030),
                          st.integers(1, 12), st.integers(0, 32)), min_size=20, max_size=80))
def test_month_span_and_iso_day(spark, parts):
    """X7 and the top-up date check against plain integer / calendar arithmetic."""
    from datetime import date

    from chargepulse.functions.times import iso_day_ok, month_span

    rows_in = [("%04d-%02d" % (y1, m1), "%04d-%02d" % (y2, m2), "%04d-%02d-%02dT00:00:00.000Z" % (y1, m1, d))
               for y1, m1, y2, m2, d in parts]
    df = spark.createDataFrame(rows_in, "a string, b string, iso string")
    got = [(r.n, r.ok) for r in df.select(month_span("a", "b").alias("n"),
                                          iso_day_ok("iso").alias("ok")).collect()]

    def valid(y, m, d):
        try:
            date(y, m, d)
            return True
        except ValueError:
            return False

    assert got == [((y2 - y1) * 12 + (m2 - m1) + 1, valid(y1, m1, d)) for y1, m1, y2, m2, d in parts]


_FIELDS = ("serviceName", "interFacRst", "chargefee", "requestId")
_value = st.one_of(st.text(max_size=12), st.integers(-10**6, 10**6))
_message = st.dictionaries(st.sampled_from(_FIELDS), _value, max_size=4)
_line = st.one_of(
    _message.map(lambda d: ("obj", d)),
    st.sampled_from(["not json", "[1]", "42", '"text"', "{", ""]).map(lambda t: ("raw", t)))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_line, min_size=10, max_size=60), st.booleans())
def test_json_parse_matches_python(spark, lines, ascii_only):
    """Every field comes back as its text; anything but an object is bad_json."""
    import json

    from chargepulse.functions.messages import parse_json

    texts = [json.dumps(v, ensure_ascii=ascii_only) if k == "obj" else v for k, v in lines]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got = [tuple(r) for r in parse_json(df, _FIELDS).collect()]

    def expect(kind, v):
        if kind == "raw":
            return (None,) * len(_FIELDS) + (True,)
        return tuple(None if f not in v else str(v[f]) for f in _FIELDS) + (False,)

    assert got == [expect(k, v) for k, v in lines]


_amount_text = st.one_of(
    st.decimals(min_value=-10**15, max_value=10**15, places=4, allow_nan=False,
                allow_infinity=False).map(str),
    st.integers(-10**6, 10**6).map(str),
    st.sampled_from(["abc", "", "1.2.3", "--1", "12,5"]))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_amount_text, min_size=10, max_size=80))
def test_amounts_round_half_up_like_decimal(spark, texts):
    """An amount is the text rounded half-up to cents; anything else is NULL."""
    from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

    from chargepulse.functions.values import amount

    def expect(t):
        if not t.strip(" "):
            return Decimal("0.00")
        try:
            d = Decimal(t).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        except InvalidOperation:
            return None
        return d if abs(d) <= 10 ** 9 else None

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.a for r in df.select(amount("t").alias("a")).collect()]
    assert got == [expect(t) for t in texts]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.text(alphabet="ABCDEFGH", min_size=1, max_size=3), st.integers(0, 4),
                       min_size=1, max_size=40), st.integers(1, 12))
def test_top_n_with_ties_is_the_sorted_prefix(spark, counts, n):
    """K2: top-N by count descending, ties by name ascending, exactly as a full sort would give."""
    from chargepulse.operators.topn import top_n

    df = spark.createDataFrame(list(counts.items()), "province string, orders bigint")
    got = [tuple(r) for r in top_n(df, n, "orders", "province").collect()]
    assert got == sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:n]


_names = st.sampled_from(["reChargeNotifyReq", "RECHARGENOTIFYREQ", "rechargenotifyreq",
                          "sendRechargeReq", "SENDRECHARGEREQ", "makeNewOrder", None])
_codes = st.sampled_from(["0000", "9999", "1001", " 0000", None])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(_names, _codes, _codes), min_size=10, max_size=60))
def test_gates_match_their_rules(spark, msgs):
    """Name any case (F3: exact case) and result code exactly 0000; missing = no."""
    from chargepulse.operators import gates as G

    df = spark.createDataFrame(msgs, "serviceName string, interFacRst string, bussinessRst string")
    got = [tuple(r) for r in df.select(G.notify_business_gate(), G.notify_interface_gate(),
                                       G.notify_ods_gate(), G.request_gate()).collect()]

    def rule(name, ifc, biz):
        low = name.lower() if name else None
        return (low == "rechargenotifyreq" and biz == "0000",
                low == "rechargenotifyreq" and ifc == "0000",
                name == "reChargeNotifyReq" and ifc == "0000",
                low == "sendrechargereq" and ifc == "0000")

    assert got == [rule(*m) for m in msgs]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.tuples(st.sampled_from(["g1", "g2"]),
                                 st.sampled_from(["t", "a-b", "x-y-z", "bigtopic"]),
                                 st.integers(0, 30)),
                       st.integers(0, 10**9), min_size=1, max_size=30))
def test_ledger_json_matches_python(spark, ledger):
    """S3: one JSON document per group; topics keep their hyphens; every offset kept."""
    import json

    from chargepulse.sources.offsets import starting_offsets_json

    df = spark.createDataFrame([(g, f"{t}-{p}", str(o)) for (g, t, p), o in ledger.items()],
                               "group_id string, field string, offset string")
    got = {r.group_id: (r.partitions, json.loads(r.starting_offsets))
           for r in starting_offsets_json(df).collect()}
    want = {}
    for (g, t, p), o in ledger.items():
        want.setdefault(g, {}).setdefault(t, {})[str(p)] = o
    assert got == {g: (sum(len(v) for v in d.values()), d) for g, d in want.items()}


_msg_fields = st.fixed_dictionaries({
    "serviceName": st.sampled_from(["reChargeNotifyReq", "RECHARGENOTIFYREQ", "sendRechargeReq", None]),
    "interFacRst": st.sampled_from(["0000", "9999", None]),
    "bussinessRst": st.sampled_from(["0000", "1001", None]),
    "provinceCode": st.sampled_from(["1", "2", "99", None]),
    "chargefee": st.sampled_from(["10.50", "3", "abc", None]),
    "requestId": st.sampled_from(["20240101000352824000000000000001", "2024010100", "20241301000352824", None]),
    "receiveNotifyTime": st.sampled_from(["20240101000353824", "20240230000000000", None]),
})


def _expected_reason(m):
    """The quarantine rules for the interface gate, written out plainly."""
    name = m["serviceName"]
    if name is None:
        return "missing_service"
    matches = name.lower() == "rechargenotifyreq"
    if matches and m["interFacRst"] is None:
        return "missing_result"
    if not (matches and m["interFacRst"] == "0000"):
        return "dropped"
    ok = m["bussinessRst"] == "0000"
    fee = m["chargefee"]
    if (fee is not None and fee == "abc") or (ok and fee is None):
        return "bad_amount"

    def good_time(t):
        return t is not None and t[:17] in ("20240101000352824", "20240101000353824")

    if not (good_time(m["requestId"]) and good_time(m["receiveNotifyTime"])):
        return "bad_time"
    if m["provinceCode"] not in ("1", "2"):
        return "unknown_province"
    return "ok"


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_msg_fields, min_size=10, max_size=60))
def test_quarantine_reasons_follow_the_rules(spark, msgs):
    import json

    from chargepulse.operators import clean as C
    from chargepulse.sources.dimension import province_dim

    dim = province_dim(spark.createDataFrame([("1 Beijing",), ("2 Shanghai",)], "value string"))
    log = spark.createDataFrame(
        [(json.dumps({k: v for k, v in m.items() if v is not None}),) for m in msgs], "value string")
    got = sorted(r.reason or "ok" for r in C.notify_rows(log, dim).collect())
    want = sorted(r for r in map(_expected_reason, msgs) if r != "dropped")
    assert got == want


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(st.sampled_from(["d1", "d2", "d3", "d4"]), st.integers(0, 100),
                                min_size=1, max_size=4), min_size=1, max_size=4),
       st.lists(st.integers(0, 3), max_size=3))
def test_changelog_resolves_to_newest_batch(spark, batches, replays):
    """After any batches and replays of earlier batches, each key has its newest batch's value."""
    from chargepulse.session import work_dir
    from chargepulse.streaming.sinks import ChangelogUpsert, read_current

    path = work_dir(spark, "prop-changelog") + "/t"
    sink = ChangelogUpsert(path)
    frames = [spark.createDataFrame(list(b.items()), "day string, total bigint") for b in batches]
    for i, df in enumerate(frames):
        sink(df, i)
    for r in replays:                      # a replayed batch writes the same rows again
        if r < len(frames):
            sink(frames[r], r)
    want = {}
    for b in batches:
        want.update(b)
    got = {r.day: r.total for r in read_current(spark, path, ["day"]).collect()}
    assert got == want
