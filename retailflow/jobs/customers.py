"""Contacts, customer union, loyalty points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import blank_to_null, money, not_blank
from ..operators.groups import BLOCK_ROWS, collapse, weighted_count
from ..operators.keys import first_per_key, source_order
from ..operators.lookup import lookup

LAYOUT = ("source", "id", "first_name", "last_name", "email", "phone", "address1", "address2", "city", "state",
          "country", "postal_code")


def full_name() -> Column:
    return F.concat(F.coalesce("first_name", F.lit("")), F.lit(" "), F.coalesce("last_name", F.lit("")))


def one_or_join(df: DataFrame, by: Sequence[str], cols: Sequence[str], sep: str, order: str,
                block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per group: the value when there is one distinct value, else all values joined in source order."""
    by = list(by)
    out = collapse(df, by, order, sep, {c: f"__all_{c}" for c in cols}, mins={c: f"__lo_{c}" for c in cols},
                   maxs={c: f"__hi_{c}" for c in cols}, block_rows=block_rows)
    single = [F.when(F.col(f"__lo_{c}") == F.col(f"__hi_{c}"), F.col(f"__lo_{c}")).otherwise(F.col(f"__all_{c}")).alias(c)
              for c in cols]
    return out.select(*by, *single)


CONTACT_FIELDS = ("phone_number", "email_address")


def _named(customers: DataFrame) -> DataFrame:
    return customers.withColumns({"name": full_name(), **{c: blank_to_null(c) for c in CONTACT_FIELDS}}).filter(F.trim("name") != "")


def consolidate_contacts(customers: DataFrame, order: str = "_pos") -> DataFrame:
    """One row per customer name with its phone and e-mail (several: joined by ``|``); nameless rows dropped.

    The form an upload takes: a name's text is as long as its values.  ``contact_values`` has the same values as rows.
    """
    return one_or_join(_named(customers), ["name"], list(CONTACT_FIELDS), "|", order)


def ambiguous_contacts(contacts: DataFrame) -> DataFrame:
    return contacts.filter(F.col("email_address").contains("|"))


def contact_values(customers: DataFrame, order: str = "_pos") -> DataFrame:
    """A row per name, field and distinct value: how often it occurs and where first.  Nameless rows and blank values are dropped.

    However many values a name has, no row grows with them; counts are partial before the exchange.
    """
    long = _named(customers).unpivot(["name", order], list(CONTACT_FIELDS), "field", "value").filter(F.col("value").isNotNull())
    return long.groupBy("name", "field", "value").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_pos"))


def contact_conflicts(customers: DataFrame, order: str = "_pos") -> DataFrame:
    """The contact values, as rows, of names with several of one field: number of distinct values and occurrences beside each."""
    values = contact_values(customers, order)
    several = values.groupBy("name", "field").agg(F.count(F.lit(1)).alias("n_values"), F.sum("n").alias("n_rows")).filter(F.col("n_values") > 1)
    return values.join(several, ["name", "field"])


def named_emails(customers: DataFrame) -> DataFrame:
    """One row per e-mail, then one per name: the simple contact table of the points and report jobs.

    An e-mail belongs to the first customer that has it; if that one has no name, to nobody.
    """
    order = source_order(customers)
    once = first_per_key(customers.withColumn("name", full_name()), "email_address", order)
    return first_per_key(once.filter((F.trim("name") != "") & not_blank("email_address")), "name", order)


def union_customers(pos: DataFrame, pos2: DataFrame, card: DataFrame) -> DataFrame:
    """Customers of three systems in one layout."""
    blank = F.lit("")
    a = pos.withColumn("source", F.lit("pos"))
    b = pos2.withColumns({"source": F.lit("pos2"), "country": F.lit("CA")})
    c = card.withColumns({"source": F.lit("card"), "last_name": blank, "phone": blank})
    return a.select(*LAYOUT).unionByName(b.select(*LAYOUT)).unionByName(c.select(*LAYOUT))


def clean_email(c: str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.col(c), ",.*", ""), '"', "")


def loyalty_points(payments: DataFrame, customers: DataFrame) -> DataFrame:
    """Whole points per successful payment of a customer with an e-mail; zero points dropped."""
    paid = payments.filter(F.col("result") == "SUCCESS")
    paid = lookup(paid, named_emails(customers), {"customer_name": "name"}, {"email_address": "email"}, unique=True)
    points = (F.col("amount") - F.coalesce("refund_amount", F.lit(0))).cast("int")
    return paid.filter(F.col("email").isNotNull()).select(clean_email("email").alias("email"), points.alias("points")).filter(F.col("points") != 0)


def pos2_points(payments: DataFrame, customers: DataFrame) -> DataFrame:
    """Whole points of the second POS: collected amount per payment of a known customer."""
    paid = lookup(payments.filter(not_blank("customer_id")), customers, "customer_id", ["email"], unique=True)
    out = paid.select("email", money("total_collected").cast("int").alias("points"))
    return out.filter(F.col("email").isNotNull() & (F.col("points") != 0))


def points_backlog(backlog: DataFrame, errors: DataFrame) -> DataFrame:
    """Points per e-mail over the old backlog and the newly rejected rows."""
    return weighted_count(backlog.select("email", "points").unionByName(errors.select("email", "points")), "email", "points", "points")
