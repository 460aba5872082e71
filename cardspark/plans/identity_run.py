"""Production run of the identity tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardspark.operators import identity as idn
from cardspark.operators.clean import IdentityRules
from cardspark.plans.card_status import CARDS
from cardspark.plans.warehouse import Warehouse
from cardspark.session import written

USERS, PHONES, PERSONS, MASTER, LOG = "users", "phones", "persons", "master", "user_changes"


def first_build(house: Warehouse, rules: IdentityRules = IdentityRules()) -> DataFrame:
    """All identity tables from the card snapshot."""
    base = written(idn.identity_base(house.table(CARDS), rules), "identity-base")
    users = house.replace(USERS, idn.bootstrap_users(base))
    phones = house.replace(PHONES, idn.phone_ids(base))
    persons = house.replace(PERSONS, idn.person_keys(base))
    return house.replace(MASTER, idn.master(base, users, phones, persons))


def daily_run(house: Warehouse, as_of: dt.datetime, rules: IdentityRules = IdentityRules()) -> DataFrame:
    """Resolve new and changed cards, log changed ids, carry them to all rows.

    New versions are written beside the old tables and swapped one by one; the
    old master stays readable until its replacement is complete.
    """
    old_master = written(house.table(MASTER), "master-before")
    todo = idn.cards_to_resolve(house.table(CARDS), old_master, house.table("customer_changes"), as_of, rules)
    base = written(idn.identity_base(todo, rules), "identity-base")
    phones = house.replace(PHONES, idn.phone_ids(base, house.table(PHONES)))
    persons = house.replace(PERSONS, idn.person_keys(base, house.table(PERSONS)))
    # a changed card brings the id it had, so its old and new contacts stay one user
    had = old_master.select(idn.CARD, "USER_ID")
    keyed = base.withColumn("combinaison", idn.person_key()).join(had, idn.CARD, "left")
    new = keyed.groupBy(*idn.CONTACT).agg(F.min("USER_ID").alias("USER_ID"))
    last = max(idn.max_id(old_master, "USER_ID"), idn.max_id(house.table(USERS), "USER_ID"))
    users = house.replace(USERS, idn.resolve_incremental(house.table(USERS), new, last))
    new_master = written(idn.master(base, users, phones, persons, old_master), "master-new")
    log = idn.user_changes(old_master, new_master, as_of)
    if house.exists(LOG):
        log = house.table(LOG).unionByName(log)
    log = written(log, "id-log")
    users_now, log_now, master_now = idn.propagate_changes(log, written(users, "users"), new_master, as_of)
    house.replace(USERS, users_now)
    house.replace(LOG, log_now)
    return house.replace(MASTER, master_now)
