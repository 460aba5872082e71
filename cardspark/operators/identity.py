"""Resolve cards to users through shared phones, e-mails and person keys."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardspark.functions.dates import timestamp
from cardspark.functions.text import normalize_phone, person_key
from cardspark.functions.values import matches
from cardspark.operators.clean import IdentityRules, eligible_cards, normalize_identity, quality_flags
from cardspark.operators.components import components
from cardspark.operators.lookup import HOT_ROWS, lookup, match, small
from cardspark.operators.numbering import number_rows
from cardspark.session import written

CARD = "CardHolderID"
BASE = [CARD, "NoMobile", "Email", "FirstName", "LastName", "BirthDate", "PostCode", "Address1", "Address2",
        "ActivationDate"]
CONTACT = ["NoMobile", "Email", "combinaison", "GoodEmail", "GoodCombinaison"]


def identity_base(cards: DataFrame, rules: IdentityRules = IdentityRules()) -> DataFrame:
    """Eligible cards with normalised attributes and quality flags."""
    kept = eligible_cards(cards, rules).select(*BASE)
    clean = normalize_identity(kept).withColumns({
        "NoMobile": normalize_phone("NoMobile"), "BirthDate": F.col("BirthDate").cast("string"),
    })
    return quality_flags(clean, rules)


def contacts_of(base: DataFrame) -> DataFrame:
    """Distinct (phone, e-mail, person key, flags) of the cards."""
    return base.withColumn("combinaison", person_key()).select(*CONTACT).distinct()


def max_id(df: DataFrame, column: str) -> int:
    top = df.agg(F.max(column)).first()[0]
    return int(top) if top is not None else 0


def assign_ids(existing: DataFrame | None, keys: DataFrame, key: str, name: str) -> DataFrame:
    """Existing (id, key, …) rows and new keys numbered after the largest id.

    `keys` may carry further columns; a key that exists keeps its row.
    """
    if existing is None:
        return number_rows(keys, [key], name).select(name, *keys.columns)
    fresh = keys.join(existing.select(key), key, "left_anti").select(*keys.columns)
    numbered = number_rows(fresh, [key], name, after=max_id(existing, name))
    return existing.select(name, *keys.columns).unionByName(numbered.select(name, *keys.columns))


def cards_per_phone(base: DataFrame) -> DataFrame:
    return base.groupBy("NoMobile").agg(F.count("*").alias("NUM_CARTES"))


def phone_ids(base: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """MOBILE_ID per phone, with the number of cards when it was first seen."""
    return assign_ids(existing, cards_per_phone(base), "NoMobile", "MOBILE_ID")


def person_keys(base: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """PERSON_ID per distinct good person key."""
    good = base.filter(F.col("GoodCombinaison") == 1).select(person_key().alias("combinaison")).distinct()
    return assign_ids(existing, good, "combinaison", "PERSON_ID")


def with_person_id(master: DataFrame, persons: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """PERSON_ID of the person key, or `<USER_ID>_<MOBILE_ID>` when the key is not good."""
    good = F.col("GoodCombinaison") == 1
    keyed = master.drop("PERSON_ID").withColumn("combinaison", F.when(good, person_key()))
    ids = persons.select("combinaison", F.col("PERSON_ID").cast("string").alias("PERSON_ID"))
    named = _by_key(keyed, ids, "combinaison", hot_rows)
    return named.withColumn("PERSON_ID", F.when(good, F.col("PERSON_ID")).otherwise(_own_person())).drop("combinaison")


def _own_person() -> Column:
    return F.concat_ws("_", F.col("USER_ID").cast("string"), F.col("MOBILE_ID").cast("string"))


def _by_key(df: DataFrame, table: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """Join values that are unique per key; many rows of `df` may share one key."""
    carried = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__carried"))
    return lookup(df, carried.join(table, key, "left"), [key], "__carried", hot_rows)


def _links(rows: DataFrame, key: str, good: str | None, hot_rows: int, total: int) -> DataFrame:
    """Edges from each row to the smallest row with the same key."""
    usable = rows.filter(F.col(key).isNotNull() if good is None else F.col(key).isNotNull() & (F.col(good) == 1))
    if key == "Email":
        usable = usable.filter(F.col(key) != "")
    usable = usable.select(key, "__row")
    groups = usable.groupBy(key).agg(F.min("__row").alias("__first"), F.count("*").alias("__n"))
    joined = match(usable, groups.filter(F.col("__n") > 1), key, "__n", hot_rows, total)
    return joined.filter(F.col("__row") > F.col("__first")).select(
        F.col("__row").alias("hi"), F.col("__first").alias("lo")
    )


def _components(contacts: DataFrame, hot_rows: int) -> DataFrame:
    """Contacts with `__row` (rank) and `__root` (smallest rank of their component)."""
    rows = number_rows(contacts, CONTACT, "__row")
    total = rows.count()
    edges = (
        _links(rows, "NoMobile", None, hot_rows, total)
        .unionByName(_links(rows, "Email", "GoodEmail", hot_rows, total))
        .unionByName(_links(rows, "combinaison", "GoodCombinaison", hot_rows, total))
    )
    roots = components(edges, hot_rows).select(F.col("node").alias("__row"), F.col("component").alias("__root"))
    return rows.join(roots, "__row", "left").withColumn("__root", F.coalesce("__root", "__row"))


def dense_ids(roots: DataFrame, last_id: int = 0, root: str = "__root") -> DataFrame:
    """USER_ID = last_id + rank of the component, on the list of components."""
    return number_rows(roots, [root], "USER_ID", after=last_id)


def resolve_users(base: DataFrame, last_id: int = 0, hot_rows: int = HOT_ROWS) -> DataFrame:
    """USER_ID per contact: connected components over equal phone, good e-mail or
    good person key, numbered by the smallest contact of each."""
    contacts = contacts_of(base).filter(F.col("NoMobile").isNotNull())
    rooted = _components(contacts, hot_rows)
    ids = dense_ids(rooted.groupBy("__root").agg(F.count("*").alias("__n")), last_id)
    return lookup(rooted, ids, ["__root"], "__n", hot_rows).select(*CONTACT, "USER_ID")


#: (key, flag that must be 1 for the key to link) of the three kinds of shared keys
KEYS = (("NoMobile", None), ("Email", "GoodEmail"), ("combinaison", "GoodCombinaison"))


def _usable(key: str, good: str | None) -> Column:
    ok = F.col(key).isNotNull()
    if good is not None:
        ok &= F.col(good) == 1
    if key == "Email":
        ok &= F.col(key) != ""
    return ok


def _keys_of(rows: DataFrame, value: str) -> DataFrame:
    """(kind, key, value) for every usable key of the rows."""
    parts = [rows.filter(_usable(key, good)).select(F.lit(key).alias("kind"), F.col(key).cast("string").alias("key"),
                                                    F.col(value)) for key, good in KEYS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def key_index(users: DataFrame) -> DataFrame:
    """(kind, key, USER_ID): the user ids that resolved contacts give each usable key.

    Built once from a resolution and kept beside it; a later incremental run
    joins only the new contacts' keys against it.
    """
    rows = users.filter(F.col("NoMobile").isNotNull()).select(*CONTACT, F.col("USER_ID").cast("long").alias("USER_ID"))
    return _keys_of(rows, "USER_ID").distinct()


def resolve_incremental(
    known: DataFrame, new: DataFrame, last_id: int | None = None, hot_rows: int = HOT_ROWS,
    index: DataFrame | None = None,
) -> DataFrame:
    """USER_ID of known and new contacts together, by components of the touched graph only.

    A component that touches known ids takes the smallest of them; the others
    are numbered after `last_id`. `new` may carry the id its card had before.

    Nodes are the new contacts, numbered after every known id, and the known
    user ids themselves. Edges: new contacts that share a key, a new contact
    and each id its keys have in `index` (see `key_index`, built from `known`
    when not given), and two ids that one known key carries. The smallest
    node of a component is then its smallest known id, or its first new
    contact; a former id carried by a new contact lowers its component's id
    like a known one. Known contacts are not re-linked: an id map (merged id
    -> final id) is applied to them, broadcast when its counted rows stay
    under the limit of `small`. Equal to a run over all contacts when `known`
    is a resolution (each id one component of its keys).
    """
    if "USER_ID" not in new.columns:
        new = new.withColumn("USER_ID", F.lit(None).cast("long"))
    last_id = max_id(known, "USER_ID") if last_id is None else last_id
    old = known.filter(F.col("NoMobile").isNotNull()).select(*CONTACT, F.col("USER_ID").cast("long").alias("USER_ID"))
    fresh = new.filter(F.col("NoMobile").isNotNull()).groupBy(*CONTACT).agg(F.min(F.col("USER_ID").cast("long")).alias("__hint"))
    index = key_index(old) if index is None else index
    top = max(last_id, max_id(old, "USER_ID"), max_id(fresh, "__hint"))
    rows = number_rows(fresh, CONTACT, "__row", after=top)
    total = rows.count()
    if total == 0:
        return old
    keys = _keys_of(rows, "__row")
    found = index.join(small(keys), ["kind", "key"]).select(F.col("__row").alias("hi"), F.col("USER_ID").alias("lo"))
    among = (_links(rows, "NoMobile", None, hot_rows, total)
             .unionByName(_links(rows, "Email", "GoodEmail", hot_rows, total))
             .unionByName(_links(rows, "combinaison", "GoodCombinaison", hot_rows, total)))
    # a key that known contacts gave two ids joins them (only a known side that was not one resolution has such keys)
    shared = index.join(small(keys.select("kind", "key").distinct()), ["kind", "key"], "left_semi")
    low = shared.groupBy("kind", "key").agg(F.min("USER_ID").alias("lo"))
    twins = shared.join(low, ["kind", "key"]).filter(F.col("USER_ID") > F.col("lo")).select(
        F.col("USER_ID").alias("hi"), "lo")
    roots = written(components(found.unionByName(among).unionByName(twins), hot_rows), "roots")
    rooted = rows.join(roots.withColumnRenamed("node", "__row"), "__row", "left").withColumn(
        "__root", F.coalesce("component", "__row"))
    # a former id counts like a known id of the component, without linking it to that id's other contacts
    per_root = written(rooted.groupBy("__root").agg(F.count("*").alias("__n"), F.min("__hint").alias("__hint")).select(
        "__root", "__n", F.least(F.when(F.col("__root") <= top, F.col("__root")), F.col("__hint")).alias("__final")),
        "roots")
    numbered = dense_ids(per_root.filter(F.col("__final").isNull()).select("__root", "__n"), last_id).unionByName(
        per_root.filter(F.col("__final").isNotNull()).select("__root", "__n", F.col("__final").alias("USER_ID")))
    named = lookup(rooted, numbered, ["__root"], "__n", hot_rows).select(*CONTACT, "USER_ID")
    finals = per_root.filter(F.col("__final").isNotNull()).select("__root", "__final")
    merged = roots.filter(F.col("node") <= top).join(finals, F.col("component") == F.col("__root")).select(
        F.col("node").alias("USER_ID"), F.col("__final").alias("__to"))
    lowered = finals.filter((F.col("__root") <= top) & (F.col("__final") < F.col("__root"))).select(
        F.col("__root").alias("USER_ID"), F.col("__final").alias("__to"))
    moves = merged.unionByName(lowered).filter(F.col("__to") != F.col("USER_ID"))
    moved = old.join(small(moves), "USER_ID", "left").select(*CONTACT, F.coalesce("__to", "USER_ID").alias("USER_ID"))
    # a new contact equal to a known one is already among the known rows, with the same id
    # (known rows equal to a new one number at most the new rows, so both joins can broadcast)
    tagged = [F.col(c).alias("__t_" + c) for c in CONTACT]
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col("__t_" + c)) for c in CONTACT])
    seen = old.join(small(rows.select(*tagged)), same, "left_semi").select(*tagged)
    added = named.join(small(seen), same, "left_anti")
    return moved.unionByName(added.select(*CONTACT, "USER_ID"))


def cards_to_resolve(
    cards: DataFrame, master: DataFrame, changes: DataFrame, as_of: dt.datetime, rules: IdentityRules = IdentityRules()
) -> DataFrame:
    """Cards without user id, and known cards whose identity changed since the day before."""
    has_id = master.filter(F.col("USER_ID").isNotNull()).select(CARD).distinct()
    fine = F.col("NoMobile").isNotNull() & ~matches("Email", rules.excluded_emails)
    without = cards.filter(fine).join(has_id, CARD, "left_anti")
    since = dt.datetime.combine((as_of - dt.timedelta(days=1)).date(), dt.time())
    moved = changes.filter(
        (F.col("dt_change") >= timestamp(since)) & fine
        & ((F.col("Is_ch_BirthDate") == 1) | (F.col("Is_ch_Email") == 1)
           | (F.col("Is_ch_LastName") == 1) | (F.col("Is_ch_NoMobile") == 1))
    ).select(CARD)
    changed = cards.join(moved.join(has_id, CARD, "left_semi"), CARD, "left_semi")
    return without.unionByName(changed)


def user_of_phone(users: DataFrame) -> DataFrame:
    return users.groupBy("NoMobile").agg(F.min("USER_ID").alias("USER_ID"))


def with_user_id(master: DataFrame, users: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """USER_ID of every row by its phone."""
    return _by_key(master.drop("USER_ID"), user_of_phone(users), "NoMobile", hot_rows)


def master(
    treated: DataFrame, users: DataFrame, phones: DataFrame, persons: DataFrame,
    previous: DataFrame | None = None, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Master table: treated cards replace their rows, every row gets its user id again."""
    base = [*BASE, "GoodEmail", "GoodCombinaison"]
    ids = phones.select("NoMobile", "MOBILE_ID")
    fresh = _by_key(treated.select(*base), ids, "NoMobile", hot_rows)
    fresh = fresh.withColumn("CONTACT_ID", F.col(CARD))
    if previous is not None:
        kept = previous.join(treated.select(CARD).distinct(), CARD, "left_anti")
        fresh = kept.select(*fresh.columns).unionByName(fresh)
    return with_person_id(with_user_id(fresh, users, hot_rows), persons, hot_rows)


def user_changes(old_master: DataFrame, new_master: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Rows of the new master whose user id differs, with the old id and the day before."""
    old = old_master.select(CARD, F.col("USER_ID").alias("__old"))
    day = as_of - dt.timedelta(days=1)
    return (
        new_master.join(old, CARD).filter(F.col("USER_ID") != F.col("__old"))
        .withColumn("USER_ID", F.col("__old")).drop("__old")
        .withColumn("dt_change", timestamp(day)).select(*new_master.columns, "dt_change")
    )


def id_map(log: DataFrame, master: DataFrame, as_of: dt.datetime) -> DataFrame:
    """(old id, current id) from log entries since the day before; smallest current id per old one."""
    since = dt.datetime.combine((as_of - dt.timedelta(days=1)).date(), dt.time())
    recent = log.filter(F.col("dt_change") >= timestamp(since)).select(CARD, F.col("USER_ID").alias("__old"))
    return (
        recent.join(master.select(CARD, "USER_ID"), CARD)
        .groupBy("__old").agg(F.min("USER_ID").alias("__current"))
    )


def propagate_changes(
    log: DataFrame, users: DataFrame, master: DataFrame, as_of: dt.datetime, hot_rows: int = HOT_ROWS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Carry recent id changes to every row that still has an old id.

    Returns (users, log, master): users with current ids, the log extended by
    the cards that still carried an old id, master refreshed by phone.
    """
    mapping = id_map(log, master, as_of).withColumnRenamed("__old", "USER_ID")
    moved = _by_key(users, mapping, "USER_ID", hot_rows)
    users_now = moved.withColumn("USER_ID", F.coalesce("__current", "USER_ID")).select(*users.columns)
    stale = _by_key(master, mapping, "USER_ID", hot_rows).filter(F.col("__current").isNotNull())
    logged = log.unionByName(stale.select(*master.columns).withColumn("dt_change", timestamp(as_of)))
    refreshed = with_user_id(master, users_now, hot_rows).select(*master.columns)
    bad = F.col("GoodCombinaison") == 0
    refreshed = refreshed.withColumn("PERSON_ID", F.when(bad, _own_person()).otherwise(F.col("PERSON_ID")))
    return users_now, logged, refreshed


def bootstrap_users(master: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """First build: every contact with a phone enters the component search."""
    return resolve_users(master, 0, hot_rows)


def attach_users(master: DataFrame, users: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """USER_ID by phone, then by good person key where still missing."""
    named = with_user_id(master, users, hot_rows)
    missing = F.col("USER_ID").isNull() & (F.col("GoodCombinaison") == 1)
    keyed = named.withColumn("combinaison", F.when(missing, person_key()))
    good = users.filter(F.col("GoodCombinaison") == 1).groupBy("combinaison").agg(F.min("USER_ID").alias("__by_key"))
    found = _by_key(keyed, good, "combinaison", hot_rows)
    return found.withColumn("USER_ID", F.coalesce("USER_ID", "__by_key")).drop("combinaison", "__by_key")


def contact_ambiguity(master: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per contact: its cards, and how many cards share its e-mail and its phone."""
    rows = master.withColumn("combinaison", person_key())
    contacts = rows.groupBy(*CONTACT).agg(F.count("*").alias("num_cards"))

    def shared(key: str, name: str) -> DataFrame:
        return contacts.filter(F.col(key).isNotNull()).groupBy(key).agg(
            F.sum("num_cards").alias(name), F.count("*").alias("__n")
        )

    out = lookup(contacts, shared("Email", "num_email"), ["Email"], "__n", hot_rows)
    return lookup(out, shared("NoMobile", "num_nomobile"), ["NoMobile"], "__n", hot_rows)


def ambiguous_contacts(ambiguity: DataFrame) -> DataFrame:
    """Contacts that share a phone or an e-mail with another card, most cards first."""
    e, p = F.col("num_email"), F.col("num_nomobile")
    return ambiguity.filter(((e > 1) & (p >= 1)) | ((e == 1) & (p > 1)) | (e.isNull() & (p > 1))).orderBy(
        F.desc("num_cards"), *CONTACT
    )


def conflicting_keys(users: DataFrame) -> DataFrame:
    """Phones, good e-mails and good person keys that carry more than one user id."""
    def over(kind: str, key: str, rows: DataFrame) -> DataFrame:
        pairs = rows.filter(F.col(key).isNotNull()).select(F.col(key).alias("key_value"), "USER_ID")
        return (
            pairs.groupBy("key_value").agg(
                F.count_distinct("USER_ID").alias("num_users")
            ).filter(F.col("num_users") > 1).select(F.lit(kind).alias("key_kind"), "key_value", "num_users")
        )

    return (
        over("NoMobile", "NoMobile", users)
        .unionByName(over("Email", "Email", users.filter(F.col("GoodEmail") == 1)))
        .unionByName(over("combinaison", "combinaison", users.filter(F.col("GoodCombinaison") == 1)))
    )
