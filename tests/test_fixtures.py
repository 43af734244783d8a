"""Golden results on small hand-typed tables."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tablestream.functions import scalar as S, udfs as U
from tablestream.operators import (aggs as A, cdc as C, changelog as L, dedup as DD, joins as J, nested as N, over as O, patterns as X,
                                   quality as Q, temporal as T, windows as W)

from .conftest import rows


def ts(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def orders(spark):
    return spark.createDataFrame([
        (1, 1, "USER_1", "BANANA", 10), (2, 2, "USER_2", "RAISIN", 20), (3, 3, "USER_1", "PIZZA", 12), (4, 4, "USER_2", "APPLE", 15),
        (5, 5, "USER_1", "APPLE", 5), (6, 6, "USER_2", "BANANA", 15), (7, 7, "USER_3", "BANANA", 10), (8, 8, "USER_3", "PIZZA", 10),
        (9, 9, "USER_2", "POPCORN", 5), (10, 7, "USER_3", "BANANA", 11)], "seq int, order_id int, user_id string, product_id string, quantity int")


def test_totals_with_and_without_dedup(orders):
    plain = rows(A.agg(orders, "product_id", {"total": ("sum", "quantity")}))
    exact = rows(A.dedup_then_agg(orders, "order_id", "seq", "product_id", {"total": ("sum", "quantity")}))
    assert plain == [("APPLE", 20), ("BANANA", 46), ("PIZZA", 22), ("POPCORN", 5), ("RAISIN", 20)]
    assert exact == [("APPLE", 20), ("BANANA", 36), ("PIZZA", 22), ("POPCORN", 5), ("RAISIN", 20)]


def test_changelog_chain_keeps_unknown_product(spark, orders):
    p = spark.createDataFrame([("BANANA", "Banana fruit", 1), ("PIZZA", "Pizza marguarita", 1), ("RAISIN", "Grappe fruit", 1), ("APPLE", "Apple fruit", 1)],
                              "product_id string, description string, v int")
    got = dict(rows(L.changelog_chain(orders, "order_id", "seq", p, "product_id", "v"), "order_id", "description"))
    assert len(got) == 9 and got[9] is None and got[7] == "Banana fruit"


def test_retract_totals_follow_updates(spark):
    v = spark.createDataFrame([("a", 1, 10), ("b", 1, 5), ("a", 2, 7), ("a", 3, 9)], "k string, seq int, v int")
    log = L.to_retract(v, "k", "seq", cols="v")
    assert sorted((r.row_kind, r.k, r.v) for r in log.collect()) == [("+I", "a", 10), ("+I", "b", 5), ("+U", "a", 7), ("+U", "a", 9), ("-U", "a", 7), ("-U", "a", 10)]
    assert rows(L.retract_aggregate(log.withColumn("g", F.lit(1)), "g", "v"), "total") == [(14,)]


@pytest.fixture
def over_orders(spark):
    base = [(1, 101, "2024-06-01 10:00:00", 50.0), (2, 101, "2024-06-01 10:00:05", 75.0), (3, 101, "2024-06-01 10:00:18", 25.0),
            (4, 101, "2024-06-01 10:00:36", 100.0), (5, 101, "2024-06-01 10:01:25", 40.0), (6, 102, "2024-06-01 10:01:00", 120.0)]
    return spark.createDataFrame([(i, c, ts(t), a) for i, c, t, a in base], "order_id int, customer_id int, order_ts timestamp, total_amount double")


def test_count_over_sixty_seconds(over_orders):
    d = O.over_range(over_orders, "customer_id", "order_ts", "60 seconds", {"n": ("count", "*")})
    assert rows(d, "order_id", "n") == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 2), (6, 1)]


def test_count_over_sixty_seconds_hot(over_orders, hot):
    test_count_over_sixty_seconds(over_orders)


def test_locf_and_its_maximum(spark):
    d = spark.createDataFrame([(1, ts("2024-06-01 10:00:00"), 10, 10, 100.0, 180), (2, ts("2024-06-01 10:00:01"), 10, 10, 100.0, 170),
                               (1, ts("2024-06-01 10:00:02"), 12, 20, 110.0, 160), (1, ts("2024-06-01 10:00:03"), None, None, None, None)],
                              "device_id int, ts timestamp, X int, Y int, val double, angle int")
    cols = ["X", "Y", "angle", "val"]
    assert rows(O.locf_max(d, "device_id", "ts", cols)) == [(1, 12, 20, 180, 110.0), (2, 10, 10, 170, 100.0)]
    last = rows(O.locf(d, "device_id", "ts", cols).filter("ts = timestamp'2024-06-01 10:00:03'"), *cols)
    assert last == [(12, 20, 160, 110.0)]


FX_ORDERS = [("ORD-001", "100.00", "EUR", "10:00"), ("ORD-002", "250.50", "YEN", "10:05"), ("ORD-003", "75.25", "GBP", "10:10"), ("ORD-004", "500.00", "JPY", "10:15"),
             ("ORD-005", "150.75", "EUR", "10:20"), ("ORD-006", "320.00", "YEN", "10:25"), ("ORD-007", "95.50", "GBP", "10:30"), ("ORD-008", "200.00", "EUR", "10:35"),
             ("ORD-009", "425.80", "YEN", "10:40"), ("ORD-010", "180.25", "JPY", "10:45")]
FX_RATES = [("EUR", "1.16", "10:00"), ("YEN", "0.14", "10:00"), ("GBP", "1.32", "10:00"), ("JPY", "0.0064", "10:00"),
            ("EUR", "1.17", "10:15"), ("YEN", "0.15", "10:16"), ("GBP", "1.33", "10:20"), ("JPY", "0.0065", "10:20")]


def fx(spark, rate_type="decimal(32,2)"):
    o = spark.createDataFrame([(i, D(p), c, ts(f"2024-01-15 {t}:00")) for i, p, c, t in FX_ORDERS], "order_id string, price decimal(32,2), currency string, order_time timestamp")
    r = spark.createDataFrame([(c, x, ts(f"2024-01-15 {t}:00")) for c, x, t in FX_RATES], "currency string, rate string, update_time timestamp")
    return o, r.withColumn("rate", F.col("rate").cast(rate_type))


def test_asof_conversion(spark):
    o, r = fx(spark)
    d = T.join_asof(o, r, "currency", "order_time", "update_time")
    got = {x.order_id: (x.rate, x.usd) for x in d.withColumn("usd", F.col("price") * F.col("rate")).collect()}
    assert got["ORD-001"] == (D("1.16"), D("116.0000"))
    assert got["ORD-002"] == (D("0.14"), D("35.0700"))
    assert got["ORD-004"] == (D("0.01"), D("5.0000"))            # the two-digit scale rounds 0.0064 up
    assert got["ORD-005"] == (D("1.17"), D("176.3775"))          # a version valid exactly then or before
    assert got["ORD-007"] == (D("1.33"), D("127.0150"))
    o, r = fx(spark, "decimal(18,6)")
    assert dict(rows(T.join_asof(o, r, "currency", "order_time", "update_time"), "order_id", "rate"))["ORD-004"] == D("0.006400")


def test_asof_without_versions(spark):
    o, r = fx(spark)
    assert {x.rate for x in T.join_asof(o, r.limit(0), "currency", "order_time", "update_time").collect()} == {None}
    assert T.join_asof(o, r.limit(0), "currency", "order_time", "update_time", "inner").count() == 0


def test_asof_hot_keys_give_the_same(spark, hot):
    test_asof_conversion(spark)


def join_orders(spark):
    o = [(1, 404.89, "17:36:15", 1), (2, 50.45, "17:37:15", 2), (3, 113.23, "17:38:15", 3), (4, 90.43, "17:39:15", 3), (5, 495.22, "19:39:15", 1),
         (6, 410.13, "21:36:15", 1), (7, 333.84, "21:37:15", 1), (8, 26.14, "21:38:15", 2), (9, 450.77, "21:39:15", 4), (10, 195.13, "21:40:15", 3)]
    s = [(i, f"2023-08-24 {'06' if i < 7 else '12'}:00:15") for i in range(1, 9)] + [(9, "2023-08-26 11:00:15"), (10, "2023-08-26 11:00:15")]
    orders = spark.createDataFrame([(i, a, ts(f"2023-08-23 {t}"), p) for i, a, t, p in o], "order_id int, amount double, order_ts timestamp, product_id int")
    ship = spark.createDataFrame([(f"shipment_{i}", i, ts(t)) for i, t in s], "shipment_id string, order_id int, ship_ts timestamp")
    prod = spark.createDataFrame([(1, "Product-1"), (2, "Product-2"), (3, "Product-3")], "product_id int, product_name string")
    return orders, ship, prod


def test_inner_and_left_join(spark):
    o, _, p = join_orders(spark)
    assert [r[0] for r in rows(J.join_inner(o, p, "product_id"), "order_id")] == [1, 10, 2, 3, 4, 5, 6, 7, 8]
    assert dict(rows(J.join_left(o, p, "product_id"), "order_id", "product_name"))[9] is None


@pytest.mark.parametrize("how,expected", [("inner", 8), ("left", 10), ("left_anti", 2)])
def test_interval_join_two_days(spark, how, expected):
    o, s, _ = join_orders(spark)
    d = T.join_interval(o, s, "order_id", "order_ts", "ship_ts", 0, "2 days", how)
    assert d.count() == expected
    if how == "inner":
        hours = dict(d.select("order_id", T.lead_time("order_ts", "ship_ts", "HOUR")).collect())
        assert 9 not in hours and hours[1] == 12


def test_interval_left_hot(spark, hot):
    test_interval_join_two_days(spark, "left", 10)


CART = [("C1", "P001", "ADD", 1, "U1", "2025-05-01 10:00:00"), ("C1", "P002", "ADD", 2, "U1", "2025-05-01 10:01:00"), ("C2", "P001", "ADD", 1, "U2", "2025-05-01 11:00:00")]


def carts(spark, prices, extra=()):
    e = spark.createDataFrame([(c, p, a, q, "OPEN", dt.date(2025, 5, 1), u, ts(t)) for c, p, a, q, u, t in [*CART, *extra]],
                              "cart_id string, product_id string, action string, quantity int, cart_status string, cart_date date, user_id string, event_ts timestamp")
    p = spark.createDataFrame([(i, n, D(x), True, v) for i, n, x, v in prices], "product_id string, name string, price decimal(10,2), availability boolean, updated_at int")
    return dict(rows(N.cart_snapshot(e, p), "cart_id", "total_price"))


def test_cart_totals_follow_the_price(spark):
    first = [("P001", "Laptop", "999.00", 1), ("P002", "Mouse", "29.00", 1), ("P003", "Keyboard", "79.00", 1)]
    assert carts(spark, first) == {"C1": D("1057.00"), "C2": D("999.00")}
    assert carts(spark, [*first, ("P001", "Laptop", "899.00", 2)]) == {"C1": D("957.00"), "C2": D("899.00")}
    assert carts(spark, first, [("C1", "P002", "REMOVE", 2, "U1", "2025-05-01 12:00:00")]) == {"C1": D("999.00"), "C2": D("999.00")}


def packages(spark):
    e = [("pkg_a", "2025-03-04 10:00:00", "2025-03-04 15:30:00", "new_eta"), ("pkg_b", "2025-03-04 10:00:00", "2025-03-04 15:40:00", "new_eta"),
         ("pkg_c", "2025-03-04 10:00:00", "2025-03-04 19:30:00", "new_eta"), ("pkg_a", "2025-03-04 10:30:00", "2025-03-04 15:30:00", ""),
         ("pkg_b", "2025-03-04 10:30:00", "2025-03-04 16:30:00", "new_eta"), ("pkg_d", "2025-03-02 08:00:00", "2025-03-03 16:30:00", "new_eta"),
         ("pkg_e", "2025-03-04 00:00:01", "2025-03-04 17:00:00", "new_eta")]
    return spark.createDataFrame([(p, ts(a), ts(b), k) for p, a, b, k in e], "package_id string, event_ts timestamp, expected_ts timestamp, event_type string")


def test_expected_time_changes(spark):
    d = spark.createDataFrame([("pkg_x", ts("2025-03-04 10:00:00"), ts("2025-03-04 11:30:00"), "a"), ("pkg_x", ts("2025-03-04 10:05:00"), ts("2025-03-04 11:30:00"), "b"),
                               ("pkg_x", ts("2025-03-04 10:10:00"), ts("2025-03-04 12:00:00"), "c"), ("pkg_y", ts("2025-03-04 10:15:00"), ts("2025-03-04 11:30:00"), "d"),
                               ("pkg_x", ts("2025-03-04 10:20:00"), ts("2025-03-04 11:30:00"), "e")], "package_id string, event_ts timestamp, expected_ts timestamp, payload string")
    assert rows(O.on_change(d, "package_id", "event_ts", "expected_ts"), "payload") == [("a",), ("c",), ("d",), ("e",)]
    assert rows(DD.first_per_value(d, "package_id", "expected_ts", "event_ts"), "payload") == [("a",), ("c",), ("d",)]     # a value that returns is not new


def test_cutoff_flags_silent_packages(spark):
    e = packages(spark)
    tr = spark.createDataFrame([(ts("2025-03-04 11:30:00"),)], "cutoff_ts timestamp")
    out = X.cutoff(e, tr, "package_id", "event_ts", "cutoff_ts")
    assert rows(out, "package_id", "event_type") == [("pkg_e", "proactive_no_event")]         # a-c spoke within two hours, d is too old
    assert out.first().event_ts == ts("2025-03-04 11:30:00")
    both = X.cutoff(e, tr, "package_id", "event_ts", "cutoff_ts", received=O.on_change(e, "package_id", "event_ts", "expected_ts"))
    assert both.count() == 7


def test_eta_history(spark):
    e = spark.createDataFrame([("PKG-123", ts("2025-01-30 10:00:00"), "dispatched", "WH-A"), ("PKG-123", ts("2025-01-30 14:30:00"), "in_transit", "HUB-B")],
                              "package_id string, event_ts timestamp, event_type string, current_location string")
    r = X.eta_history(e, "package_id", "event_ts", ["event_type", "current_location"], "current_location", "event_type").first()
    assert [h.event_type for h in r.event_history] == ["dispatched", "in_transit"] and r.current_location_latest == "HUB-B"
    assert (r.eta_window_start, r.eta_window_end) == (ts("2025-01-31 14:30:00"), ts("2025-01-31 16:30:00")) and (r.risk_score, r.confidence) == (0.5, 0.8)


def test_debezium_delete_takes_before(spark):
    rec = "struct<txn_id:string, account_id:string, amount:decimal(10,2)>"
    d = spark.createDataFrame([("c", None, ("t1", "acc_001", D("100.50")), (1000,)), ("u", ("t1", "acc_001", D("100.50")), ("t1", "acc_001", D("278.25")), (2000,)),
                               ("c", None, ("t2", "acc_001", D("100.50")), (1500,)), ("c", None, ("t3", "acc_002", D("7.00")), (1,)), ("d", ("t3", "acc_002", D("7.00")), None, (3000,))],
                              f"op string, before {rec}, after {rec}, source struct<ts_ms: bigint>")
    flat = C.unwrap_debezium(d, ["txn_id", "account_id", "amount"])
    assert rows(flat.filter("is_deleted"), "txn_id", "amount", "src_op") == [("t3", D("7.00"), "d")]
    live = C.cdc_latest(flat, "txn_id", "src_timestamp")
    assert rows(A.agg(live, "account_id", {"total": ("sum", "amount")})) == [("acc_001", D("378.75"))]
    assert C.cdc_latest(flat, "txn_id", "src_timestamp", keep_deleted=True).count() == 3


def test_qlik_envelope(spark):
    rec = "struct<id:string, email:string, age:int>"
    d = spark.createDataFrame([(("REFRESH", "1", "t"), ("1", "a@x.org", 30), None), (("INSERT", "2", "t"), ("2", "bad", 200), None), (("UPDATE", "3", "t"), ("1", "b@x.org", 31), ("1", "a@x.org", 30)),
                               (("DELETE", "4", "t"), None, ("2", "bad", 200)), (("INSERT", "5", "t"), None, None), (("INSERT", "6", "t"), (None, "c@x.org", 5), None)],
                              f"headers struct<operation:string, changeSequence:string, timestamp:string>, data {rec}, beforeData {rec}")
    flat = C.unwrap_qlik(d, ["id", "email", "age"])
    assert flat.count() == 5
    good, bad = Q.route_invalid(flat, {"missing id": F.col("id").isNull()})
    assert rows(Q.route_invalid(d, Q.envelope_rules())[1], "reject_reason") == [("missing_key",), ("missing_payload",)]
    assert (good.count(), rows(bad, "reject_reason")) == (4, [("missing id",)])
    fine, wrong = Q.route_business(good, "email", "age")
    assert {r.id for r in wrong.collect()} == {"2"} and fine.count() == 2
    assert rows(C.cdc_latest(good, "id", "change_sequence"), "id", "email") == [("1", "b@x.org")]
    assert C.filter_ops(flat, "operation", ["REFRESH", "DELETE"]).count() == 3


def test_group_tombstone(spark):
    e = [("grp-001", "user-100", "2025-11-01 09:00:00", False), ("grp-001", "user-101", "2025-11-01 09:05:00", False), ("grp-002", "user-200", "2025-11-02 10:10:10", False),
         ("grp-002", "user-201", "2025-11-02 10:12:00", False), ("grp-003", "user-300", "2025-11-15 14:30:22", False), ("grp-002", "", "2025-11-26 09:15:00", True),
         ("grp-003", "user-301", "2025-11-28 20:45:15", False), ("grp-001", "user-102", "2025-11-30 23:59:59", False), ("grp-002", "user-200", "2025-11-26 10:11:10", False),
         ("grp-002", "user-202", "2025-11-26 10:12:00", False)]
    d = spark.createDataFrame([(g, m, ts(t), x) for g, m, t, x in e], "group_uid string, group_member string, event_timestamp timestamp, is_deleted boolean")
    out = J.apply_group_tombstone(d, "group_uid", "group_member", "event_timestamp", "is_deleted")
    now = DD.dedup_last(out, ["group_uid", "group_member"], "event_timestamp")
    assert [r[1] for r in rows(now.filter("is_deleted"), "group_uid", "group_member")] == ["user-201"]
    assert now.count() == 8 and out.filter("is_deleted").count() == 2


HIERARCHY = [(2, "region_1", "hospital_west", "GROUP"), (3, "region_1", "hospital_east", "GROUP"), (4, "hospital_west", "department_1", "GROUP"), (5, "hospital_east", "department_11", "GROUP"),
             (6, "hospital_west", "nurses_gp_1", "GROUP"), (7, "department_1", "nurses_gp_2", "GROUP"), (8, "department_1", "Julie", "PERSON"), (9, "nurses_gp_1", "Himani", "PERSON"),
             (10, "nurses_gp_1", "Laura", "PERSON"), (11, "nurses_gp_2", "Bratt", "PERSON"), (12, "nurses_gp_2", "Caroll", "PERSON"), (13, "nurses_gp_2", "Lucy", "PERSON"), (14, "nurses_gp_2", "Mary", "PERSON")]


def test_hierarchy(spark):
    e = spark.createDataFrame(HIERARCHY, "id int, group_name string, item_name string, item_type string")
    two = {}
    for g, p in rows(J.expand_hierarchy(e, "group_name", "item_name", "item_type", depth=2)):
        two.setdefault(g, []).append(p)
    assert two["department_1"] == ["Bratt", "Caroll", "Julie", "Lucy", "Mary"] and two["hospital_west"] == ["Himani", "Julie", "Laura"] and "region_1" not in two
    full = {}
    for g, p in rows(J.expand_hierarchy(e, "group_name", "item_name", "item_type", depth=None)):
        full.setdefault(g, []).append(p)
    assert full["region_1"] == full["hospital_west"] == ["Bratt", "Caroll", "Himani", "Julie", "Laura", "Lucy", "Mary"]


def test_hierarchy_with_a_cycle_ends(spark):
    e = spark.createDataFrame([("a", "b", "GROUP"), ("b", "a", "GROUP"), ("b", "p", "PERSON")], "g string, i string, t string")
    assert rows(J.expand_hierarchy(e, "g", "i", "t", depth=None)) == [("a", "p"), ("b", "p")]


def test_or_join_keeps_each_pair_once(spark):
    e = spark.createDataFrame(HIERARCHY, "id int, group_name string, item_name string, item_type string")
    l, r = e.alias("d"), e.alias("p")
    got = J.join_any(l, r, [F.col("d.item_name") == F.col("p.group_name"), F.col("d.group_name") == F.col("p.group_name")]).filter("p.item_type = 'PERSON'")
    want = l.join(r, (F.col("d.item_name") == F.col("p.group_name")) | (F.col("d.group_name") == F.col("p.group_name"))).filter("p.item_type = 'PERSON'")
    pick = [F.col("d.id").alias("a"), F.col("p.id").alias("b")]
    assert rows(got.select(*pick)) == rows(want.select(*pick))


def test_arrays_of_latest_rows(spark):
    s = [(1, 1, "asset_1", "130.00", "2024-01-10 00:00:00", 1), (1, 2, "asset_2", "230.00", "2024-01-11 10:00:00", 2), (2, 3, "asset_3", "330.00", "2024-01-12 00:00:00", 3),
         (2, 3, "asset_3", "331.00", "2024-01-13 00:00:00", 4), (1, 5, "asset_5", "550.00", "2024-01-14 00:00:00", 5), (1, 2, "asset_2", "231.00", "2024-01-11 10:00:00", 6), (2, 7, "asset_7", "770.00", "2024-01-16 00:00:00", 7)]
    d = spark.createDataFrame([(a, b, n, D(p), ts(t), i) for a, b, n, p, t, i in s], "suite_id int, asset_id int, asset_name string, price decimal(24,4), ts timestamp, seq int")
    out = {r.suite_id: [(x.asset_id, x.price) for x in r["items"]] for r in DD.latest_then_collect(d, ["suite_id", "asset_id"], ["ts", "seq"], "suite_id", ["asset_id", "price"]).collect()}
    assert out[2] == [(3, D("331.0000")), (7, D("770.0000"))] and [a for a, _ in out[1]] == [1, 2, 5]


def test_last_load_of_each_truck(spark):
    t = spark.createDataFrame([("truck_1", [(1, "good_1", 1718000000000), (2, "good_2", 1718000100000), (3, "good_1", 1718000200000)]), ("truck_3", [(4, "good_1", 1718000300000), (6, "good_2", 1718000500000)]), ("truck_9", [])],
                              "truck_id string, loads array<struct<c_id:int, good_id:string, ts_ms:bigint>>")
    u = N.unnest(t, "loads", ["c_id", "good_id", "ts_ms"])
    assert rows(A.latest_value(u, "truck_id", "good_id", "ts_ms")) == [("truck_1", "good_1"), ("truck_3", "good_2")]
    assert N.unnest(t, "loads", ["c_id", "good_id", "ts_ms"], outer=True).count() == 6


def test_party_expansion(spark):
    e = spark.createDataFrame([("evt-sub-001", "10:05", '{"eventType":"subscription"}', ['{"account_number":"acc-001","plan_name":"Premium"}']),
                               ("evt-swap-001", "10:10", '{"eventType":"deviceSwap"}', ['{"account_number":"acc-002"}']),
                               ("evt-sub-002", "10:15", '{"eventType":"subscription"}', ['{"account_number":"acc-010","plan_name":"Family"}'])],
                              "event_id string, event_time string, context_data string, event_details array<string>")
    p = spark.createDataFrame([("party-100", "acc-001", "Austin"), ("party-100", "acc-002", "Austin"), ("party-200", "acc-010", "Denver")], "party_id string, account_number string, addr_city string")
    out = J.expand_party(e, p, "deviceSwap", "subscription", keep="addr_city")
    assert rows(out, "party_id", "related_account_id", "account_number", "plan_name") == [("party-100", "acc-001", "acc-002", "Premium"), ("party-100", "acc-002", "acc-002", None)]


def test_union_of_event_types(spark):
    e = spark.createDataFrame([(1, "open", 5.0), (2, "close", 0.0), (3, "other", 1.0)], "id int, kind string, v double")
    u = N.to_union(e, "kind", {"open": F.struct(F.col("v").alias("amount")), "close": F.struct(F.lit("done").alias("why"))})
    assert [(r.id, r.detail.open is not None, r.detail.close is not None) for r in u.orderBy("id").collect()] == [(1, True, False), (2, False, True), (3, False, False)]
    assert rows(N.split_union(u.drop("v"), "detail")["close"], "id", "why") == [(2, "done")]


def test_document_with_nested_children(spark):
    o = spark.createDataFrame([(1, "open"), (2, "open")], "order_id int, status string")
    j = spark.createDataFrame([(1, "j2"), (1, "j1")], "order_id int, job_id string")
    out = {r.order_id: [c.job_id for c in r.children] for r in N.nest_children(o, j, "order_id", "job_id").collect()}
    assert out == {1: ["j1", "j2"], 2: []}


def test_member_dimension_from_json(spark):
    doc = ('{"headers":{"op":"INSERT"},"data":{"member_id":"P123456","first_name":"John","last_name":"Doe","date_of_birth":"1980-05-15",'
           '"address":{"street":"123 Health Street","city":"Medical City","state":"MC","zip":"12345"},"phone":"555-0123"}}')
    d = spark.createDataFrame([(doc,), ('{"headers":{"op":"DELETE"},"data":{"member_id":"X"}}',)], "msg string")
    out = C.json_to_dim(d, "msg", {"member_id": ("$.data.member_id", "string"), "date_of_birth": ("$.data.date_of_birth", "date")},
                        {"address": {"street": ("$.data.address.street", "string"), "zip": ("$.data.address.zip", "string")}})
    assert [(r.member_id, r.date_of_birth, r.address.street, r.address.zip) for r in out.collect()] == [("P123456", dt.date(1980, 5, 15), "123 Health Street", "12345")]


def test_full_outer_person_location(spark):
    p = spark.createDataFrame([(1, "John"), (2, "Albert"), (3, "Lui"), (4, "Smith"), (5, "Robert")], "id int, name string")
    l = spark.createDataFrame([(1, "DC"), (2, "NY"), (4, "LA"), (6, "LU"), (7, "DL"), (8, "NH")], "id int, location string")
    assert rows(J.join_full(p, l, "id", fill="NULL")) == [(1, "John", "DC"), (2, "Albert", "NY"), (3, "Lui", "NULL"), (4, "Smith", "LA"), (5, "Robert", "NULL"),
                                                         (6, "NULL", "LU"), (7, "NULL", "DL"), (8, "NULL", "NH")]
    assert J.join_right(p, l, "id").count() == 6 and J.join_anti(p, l, "id").count() == 2


def test_employees_per_department(spark, tmp_path):
    from tablestream.sources.files import read_csv
    lines = ["1, John Doe, 101 ", "2, Jane Smith, 101 ", "3, Mike Johnson, 102 ", "4, Sarah Lee, 101 ", "5, David Brown, 102", "10, Michelle White, 102", "10, Michelle White, 102"]
    (tmp_path / "e.csv").write_text("\n".join(lines))
    e = read_csv(spark, str(tmp_path), "emp_id int, name string, dept_id int")
    assert rows(A.agg(DD.dedup_last(e, "emp_id", "name"), "dept_id", {"n": ("count", "*")})) == [(101, 3), (102, 3)]


def test_historical_and_live_mix(spark):
    cols = "user_id string, feature string, usage bigint, at timestamp"
    hist = spark.createDataFrame([("u1", "f1", 5, ts("2024-03-01 00:00:00")), ("u2", "f1", 9, ts("2024-02-01 00:00:00"))], cols)
    live = spark.createDataFrame([("u1", "f1", 2, ts("2024-01-01 00:00:00")), ("u1", "f1", 3, ts("2024-01-02 00:00:00"))], cols)
    assert rows(L.mix(hist, live, ["user_id", "feature"], "at"), "user_id", "usage", "src") == [("u1", 3, "live"), ("u2", 9, "hist")]


def test_salted_join_equals_plain(spark):
    u = spark.createDataFrame([(i, 1 if i % 4 else i % 5) for i in range(1, 201)], "id int, group_id int")
    g = spark.createDataFrame([(i, f"group_{i}") for i in range(0, 5)], "group_id int, group_name string")
    plain = rows(u.join(g, "group_id"), "id", "group_name")
    for how in ("inner", "left"):
        assert rows(J.join_salted(u, g, "group_id", n=4, how=how, share=3), "id", "group_name") == plain


def test_watermark_schedule_windows(spark):
    e = [(s, p) for s in range(0, 21) for p in range(4)] + [(s, p) for s in range(21, 60) for p in (0, 1)]
    d = spark.createDataFrame([(dt.datetime(2020, 1, 1) + dt.timedelta(seconds=s), p) for s, p in e], "event_time timestamp, partition int")
    w = W.tumble(d, "event_time", "10 seconds", None, {"n": ("count", "*")}).orderBy("window_start")
    assert len(e) == 162 and [r.n for r in w.collect()] == [40, 40, 22, 20, 20, 20]


def test_rolling_horizons_are_nested(spark):
    d = spark.createDataFrame([("u", 2.0, ts("2024-01-01 00:30:00")), ("u", 3.0, ts("2024-01-01 05:30:00")), ("u", 4.0, ts("2024-01-01 11:30:00"))], "user_id string, amount double, at timestamp")
    r = {x.feature_time: x for x in W.rolling_features(d, "at", "user_id", "amount").collect()}
    last = r[ts("2024-01-01 12:00:00")]
    assert (last.cnt_12h, last.amt_sum_12h, last.cnt_6h, last.amt_sum_6h) == (3, 9.0, 2, 7.0)
    assert all((x.cnt_6h or 0) <= x.cnt_12h for x in r.values())


def test_session_boundary(spark):
    t0 = dt.datetime(2024, 1, 1)
    d = spark.createDataFrame([("k", t0 + dt.timedelta(seconds=s)) for s in (0, 5, 11)], "k string, at timestamp")
    s = W.session(d, "at", "5 seconds", "k", {"n": ("count", "*")}).orderBy("window_start")
    assert [(r.window_end - t0).total_seconds() for r in s.collect()] == [10.0, 16.0]
    assert [r.n for r in s.collect()] == [2, 1]


def test_session_boundary_hot(spark, hot):
    test_session_boundary(spark)


def test_message_batches_have_no_deletes(spark):
    m = spark.createDataFrame([(i, ts("2024-01-01 00:00:00"), f"m{i}", "d" if i % 3 == 0 else "c") for i in range(20)], "id bigint, at timestamp, val string, op string")
    b = W.batch_messages(m, "at", F.col("id"), "val", 5, "id", "1 second", F.col("op") != "d", max_rows=2)
    lines = [x for r in b.collect() for x in r.val.split("\n")]
    assert sorted(lines) == sorted(f"m{i}" for i in range(20) if i % 3) and max(r.n for r in b.collect()) == 2


def test_trip_rows(spark):
    from tablestream.operators.relational import route
    t = spark.createDataFrame([("id_4214,PB7526,Sedan,Wanda,yes,Sector 19,Sector 10,5",), ("id_4215,PB7527,Sedan,Bob,no,Sector 19,null,5",)], "line string")
    part = lambda i: S.split_index("line", ",", i)
    d = t.select(part(3).alias("driver"), part(6).alias("destination"), (part(4) == "yes").alias("ongoing"), part(7).cast("int").alias("passengers"))
    assert rows(route(d, {"valid": F.col("ongoing")})["valid"]) == [("Wanda", "Sector 10", True, 5)]


def test_small_functions(spark):
    d = spark.createDataFrame([("13:05:09", "USA", bytes([0, 0, 0, 0, 9]) + b'{"a":1}')], "t string, place string, raw binary")
    r = d.select(S.seconds_of_day("t").alias("s"), S.format_seconds_of_day(S.seconds_of_day("t")).alias("back"), U.tax_by_location("place").alias("tax"), S.wire_schema_id("raw").alias("schema"),
                 S.json_value(S.decode_bytes(S.strip_wire_header("raw")), "$.a", "int").alias("a"), S.bucket("place", 5).alias("b")).first()
    assert (r.s, r.back, r.tax, r.schema, r.a) == (47109, "13:05:09", 10, 9, 1) and 0 <= r.b < 5
