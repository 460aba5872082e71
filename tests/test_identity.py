import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cardspark.operators import identity as idn
from cardspark.operators.clean import IdentityRules
from cardspark.session import written
from conftest import values

T = dt.datetime
COLUMNS = ("CardHolderID string, NoMobile string, Email string, LastName string, BirthDate string, GoodEmail int, GoodCombinaison int")


def base(spark, *rows):
    df = spark.createDataFrame(rows, COLUMNS)
    return df.withColumns({c: F.lit("") for c in ["FirstName", "PostCode", "Address1", "Address2"]}).withColumn(
        "ActivationDate", F.lit(None).cast("timestamp_ntz"))


CHAIN = [("1", "m1", "e1", "n1", "1980", 1, 1), ("2", "m1", "e2", "n2", "1981", 1, 1), ("3", "m3", "e2", "n3", "1982", 1, 1),
         ("4", "m4", "e4", "n3", "1982", 1, 1), ("5", "m5", "e1", "n9", "1990", 0, 1), ("6", "m6", "", "n8", "1991", 1, 0),
         ("7", "m7", "", "n8", "1991", 1, 0)]


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_a_chain_over_three_kinds_of_key(spark, hot_rows):
    got = dict(values(idn.resolve_users(base(spark, *CHAIN), hot_rows=hot_rows), "NoMobile", "USER_ID"))
    assert got == {"m1": 1, "m3": 1, "m4": 1, "m5": 2, "m6": 3, "m7": 4}


def crowd(n, seed):
    r = random.Random(seed)
    return [(str(i), f"m{r.randrange(n)}", f"e{r.randrange(n)}" if i % 3 else "shared@x", f"n{r.randrange(n)}", "1980", int(i % 5 > 0), int(i % 4 > 0))
            for i in range(n)]


def brute(rows):
    root = {}

    def find(x):
        root.setdefault(x, x)
        return x if root[x] == x else find(root[x])

    for _, m, e, n, b, ge, gc in rows:
        keys = [("m", m)] + ([("e", e)] if ge else []) + ([("p", b + n)] if gc else [])
        for k in keys[1:]:
            root[find(k)] = find(keys[0])
    groups = {}
    for _, m, *_ in rows:
        groups.setdefault(find(("m", m)), set()).add(m)
    return {frozenset(g) for g in groups.values()}


def groups(df):
    out = {}
    for m, u in values(df, "NoMobile", "USER_ID"):
        out.setdefault(u, set()).add(m)
    return {frozenset(g) for g in out.values()}


def test_groups_equal_union_find_in_any_order(spark):
    rows = crowd(120, 3)
    shuffled = random.Random(1).sample(rows, len(rows))
    first = idn.resolve_users(base(spark, *rows))
    second = idn.resolve_users(base(spark, *shuffled).repartition(5))
    assert groups(first) == brute(rows)
    assert values(first, *first.columns) == values(second, *second.columns)


def test_two_halves_group_like_one_run_and_known_ids_stay(spark):
    rows = crowd(120, 7)
    known = idn.resolve_users(base(spark, *rows[:60]))
    both = idn.resolve_incremental(known, idn.contacts_of(base(spark, *rows[60:])))
    assert groups(both) == brute(rows)
    ids = {u for (u,) in values(both, "USER_ID")}
    top = max(u for (u,) in values(known, "USER_ID"))
    assert {u for u in ids if u > top} == set(range(top + 1, top + 1 + len({u for u in ids if u > top})))
    before = dict(values(known, "NoMobile", "USER_ID"))
    assert all(after <= before[m] for m, after in values(both, "NoMobile", "USER_ID") if m in before)


def test_ids_are_appended_after_the_largest(spark):
    first = idn.phone_ids(base(spark, *CHAIN[:3]))
    assert values(first, "MOBILE_ID", "NoMobile", "NUM_CARTES") == [(1, "m1", 2), (2, "m3", 1)]
    second = idn.phone_ids(base(spark, *CHAIN), first)
    assert values(second, "MOBILE_ID", "NoMobile")[:4] == [(1, "m1"), (2, "m3"), (3, "m4"), (4, "m5")]
    persons = idn.person_keys(base(spark, *CHAIN))
    assert values(persons, "combinaison")[0] == ("1980n1",) and persons.count() == 4


def test_master_changes_and_propagation(spark):
    old_rows = [("1", "m1", "e1", "n1", "1980", 1, 1), ("2", "m2", "e2", "n2", "1981", 1, 0)]
    keep = lambda df: written(df, "test")
    users = keep(idn.resolve_users(base(spark, *old_rows)))
    phones, persons = keep(idn.phone_ids(base(spark, *old_rows))), keep(idn.person_keys(base(spark, *old_rows)))
    old = keep(idn.master(base(spark, *old_rows), users, phones, persons))
    assert values(old, "CardHolderID", "USER_ID", "MOBILE_ID", "PERSON_ID", "CONTACT_ID") == [("1", 1, 1, "1", "1"), ("2", 2, 2, "2_2", "2")]
    bridge = [("3", "m2", "e1", "n5", "1999", 1, 1)]
    merged = keep(idn.resolve_incremental(users, idn.contacts_of(base(spark, *bridge))))
    assert {u for (u,) in values(merged, "USER_ID")} == {1}
    treated = base(spark, *bridge)
    new = keep(idn.master(treated, merged, keep(idn.phone_ids(treated, phones)), keep(idn.person_keys(treated, persons)), old))
    assert values(new, "CardHolderID", "USER_ID", "PERSON_ID") == [("1", 1, "1"), ("2", 1, "1_2"), ("3", 1, "2")]
    as_of = T(2024, 2, 15, 6)
    log = idn.user_changes(old, new, as_of)
    assert values(log, "CardHolderID", "USER_ID", "dt_change") == [("2", 2, T(2024, 2, 14, 6))]
    stale_users = merged.unionByName(users.filter("USER_ID = 2").withColumn("NoMobile", F.lit("m9")))
    stale_master = new.unionByName(new.filter("CardHolderID = '2'").withColumns(
        {"CardHolderID": F.lit("9"), "NoMobile": F.lit("m9"), "USER_ID": F.lit(2).cast("long")}))
    users_now, log_now, master_now = idn.propagate_changes(log, stale_users, stale_master, as_of, hot_rows=0)
    assert {u for (u,) in values(users_now, "USER_ID")} == {1}
    assert values(log_now, "CardHolderID", "USER_ID") == [("2", 2), ("9", 2)]
    assert values(master_now, "CardHolderID", "USER_ID", "PERSON_ID") == [("1", 1, "1"), ("2", 1, "1_2"), ("3", 1, "2"), ("9", 1, "1_2")]
    assert idn.id_map(log, stale_master, T(2024, 3, 1)).count() == 0


def test_identity_base_and_eligibility(spark):
    rules = IdentityRules(excluded_emails="@issuer", bad_email="^$|^no@", bad_last_name="^none$", bad_birth_dates=["1988-08-08 00:00:00"],
                          condition="CardHolderID <> '9'")
    rows = [("1", "0033.0", " A@X ", "Du Pont", T(1980, 1, 1)), ("2", "1", "x@ISSUER.com", "b", T(1980, 1, 1)), ("3", None, "e", "c", T(1980, 1, 1)),
            ("0", "1", "e", "d", T(1980, 1, 1)), ("9", "1", "e", "d", T(1980, 1, 1)), ("4", "1", None, "NONE", T(1980, 1, 1)),
            ("5", "1", "no@x", "d", T(1988, 8, 8)), ("6", "1", "yes@x", "d", None)]
    df = spark.createDataFrame(rows, "CardHolderID string, NoMobile string, Email string, LastName string, BirthDate timestamp_ntz")
    df = df.withColumns({c: F.lit("a B") for c in ["FirstName", "PostCode", "Address1", "Address2"]}).withColumn("ActivationDate", F.col("BirthDate"))
    got = idn.identity_base(df, rules)
    assert values(got, "CardHolderID", "NoMobile", "Email", "LastName", "GoodEmail", "GoodCombinaison", "FirstName") == [
        ("1", "33", "a@x", "dupont", 1, 1, "ab"), ("4", "1", "", "none", 0, 0, "ab"), ("5", "1", "no@x", "d", 0, 0, "ab"), ("6", "1", "yes@x", "d", 1, 0, "ab")]
    assert values(got, "BirthDate")[0] == ("1980-01-01 00:00:00",)


def test_attach_by_phone_then_by_person_key(spark):
    users = spark.createDataFrame([("m1", "e", "1980a", 1, 1, 5), ("m2", "e", "1980b", 1, 0, 6)],
                                  "NoMobile string, Email string, combinaison string, GoodEmail int, GoodCombinaison int, USER_ID long")
    rows = base(spark, ("1", "m1", "e", "z", "1", 1, 1), ("2", "mX", "e", "a", "1980", 1, 1), ("3", "mX", "e", "a", "1980", 1, 0), ("4", None, "e", "b", "1980", 1, 1))
    got = idn.attach_users(rows.withColumn("USER_ID", F.lit(None).cast("long")), users, hot_rows=0)
    assert values(got, "CardHolderID", "USER_ID") == [("1", 5), ("2", 5), ("3", None), ("4", None)]


def test_ambiguity_and_conflicts(spark):
    rows = base(spark, ("1", "m1", "e1", "a", "1980", 1, 1), ("2", "m1", "e2", "b", "1980", 1, 1), ("3", "m3", None, "c", "1980", 1, 1), ("4", "m4", "e4", "d", "1980", 1, 1))
    got = idn.contact_ambiguity(rows, hot_rows=0)
    assert values(got, "NoMobile", "num_cards", "num_email", "num_nomobile") == [("m1", 1, 1, 2), ("m1", 1, 1, 2), ("m3", 1, None, 1), ("m4", 1, 1, 1)]
    assert idn.ambiguous_contacts(got).count() == 2
    users = idn.resolve_users(rows).withColumn("USER_ID", F.expr("USER_ID + CASE WHEN Email = 'e2' THEN 10 ELSE 0 END"))
    assert values(idn.conflicting_keys(users), "key_kind", "key_value", "num_users") == [("NoMobile", "m1", 2)]


def test_cards_to_resolve(spark):
    cards = base(spark, *[(c, None if c == "5" else "m", "x@issuer.example" if c == "6" else "e", "n", "1", 1, 1) for c in "123456"])
    master = spark.createDataFrame([("1", 1), ("2", 2), ("3", 3), ("4", None)], "CardHolderID string, USER_ID long")
    flags = "CardHolderID string, NoMobile string, Email string, dt_change timestamp_ntz, Is_ch_BirthDate int, Is_ch_Email int, Is_ch_LastName int, Is_ch_NoMobile int"
    log = spark.createDataFrame([("2", "m", "e", T(2024, 3, 1), 0, 1, 0, 0), ("3", "m", "e", T(2024, 2, 20), 0, 1, 0, 0), ("1", "m", "e", T(2024, 3, 1), 0, 0, 0, 0),
                                 ("4", "m", "e", T(2024, 3, 1), 1, 0, 0, 0)], flags)
    assert values(idn.cards_to_resolve(cards, master, log, T(2024, 3, 2, 9)), "CardHolderID") == [("2",), ("4",)]


CONTACTS = "NoMobile string, Email string, combinaison string, GoodEmail int, GoodCombinaison int, USER_ID long"


def plain_incremental(known, new, last_id):
    """Union-find over all contacts: the smallest known id of a component, else numbers after last_id by first contact."""
    ids = {}
    for *c, u in known + new:
        k = tuple(c)
        ids[k] = u if ids.get(k) is None else (ids[k] if u is None else min(ids[k], u))
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for k in ids:
        m, e, p, ge, gc = k
        for key in [("m", m)] + ([("e", e)] if ge == 1 and e else []) + ([("p", p)] if gc == 1 and p is not None else []):
            root[find(("c", k))] = find(key)
    comps = {}
    for k in ids:
        comps.setdefault(find(("c", k)), []).append(k)
    out, fresh = {}, []
    for members in comps.values():
        known_ids = [ids[k] for k in members if ids[k] is not None]
        if known_ids:
            out.update({k: min(known_ids) for k in members})
        else:
            fresh.append(members)
    for n, members in enumerate(sorted(fresh, key=min), start=last_id + 1):
        out.update({k: n for k in members})
    return sorted((*k, u) for k, u in out.items())


def rows_of(df):
    return [tuple(r) for r in df.select(*idn.CONTACT, "USER_ID").collect()]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_incremental_equals_a_full_run(spark, seed):
    rows = crowd(150, seed)
    cut = random.Random(seed).randrange(20, 130)
    known = written(idn.resolve_users(base(spark, *rows[:cut])), "test")
    new = idn.contacts_of(base(spark, *rows[cut - 10:]))  # ten contacts arrive again
    got = sorted(rows_of(idn.resolve_incremental(known, new)))
    top = max(u for *_, u in rows_of(known))
    assert got == plain_incremental(rows_of(known), [(*r, None) for r in values(new, *idn.CONTACT)], top)


def test_incremental_merges_ids_hints_and_conflicting_known_keys(spark):
    known = [("m1", "e1", "p1", 1, 1, 4), ("m2", "e2", "p2", 1, 1, 2), ("m3", "e3", "p3", 1, 1, 7),
             ("m4", "e3", "p4", 1, 1, 9), ("m5", "", "p5", 1, 0, 3)]  # e3 carries two ids: 7 and 9 merge
    new = [("m6", "e1", "p9", 1, 1, None), ("m7", "x", "p2", 0, 1, None),  # bridge: m6 -> 4 by e1, m7 -> 2 by p2
           ("m8", "e8", "q", 1, 1, None), ("m8", "e9", "q", 1, 1, None),  # two new contacts of one new user
           ("m6", "e7", "p7", 1, 0, None), ("m9", "", "p5", 1, 1, 3),      # hint joins m9 to 3
           ("m1", "e1", "p1", 1, 1, None), ("m7", "", "zz", 1, 1, 4),     # a known contact again; a hint in 2's component
           ("m10", "e3", "r", 1, 0, None)]                                 # touches e3, which carries 7 and 9
    k, n = spark.createDataFrame(known, CONTACTS), spark.createDataFrame(new, CONTACTS)
    got = sorted(rows_of(idn.resolve_incremental(k, n)))
    assert got == plain_incremental(known, new, 9)
    assert {u for *c, u in got if c[0] in ("m2", "m7")} == {2} and {u for *c, u in got if c[0] in ("m1", "m6")} == {4}
    assert {u for *c, u in got if c[0] in ("m3", "m4")} == {7}


def test_incremental_does_not_shuffle_known_contacts(spark, tmp_path):
    rows = crowd(200, 9)
    path = str(tmp_path / "known")
    idn.resolve_users(base(spark, *rows[:150])).write.parquet(path)
    known = spark.read.parquet(path)
    index = written(idn.key_index(known), "test")
    out = idn.resolve_incremental(known, idn.contacts_of(base(spark, *rows[150:])), index=index)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan()

    def scans_below(node, inside):
        name = node.nodeName()
        below = inside or "Exchange" in name
        found = []
        if "Scan" in name and below and path in node.toString():
            found.append(name)
        kids = [node.plan()] if name.endswith("QueryStage") else []
        kids += [node.children().apply(i) for i in range(node.children().size())]
        if name.startswith("AdaptiveSparkPlan"):
            kids = [node.executedPlan()]
        for kid in kids:
            found += scans_below(kid, below)
        return found

    assert scans_below(plan, False) == []
