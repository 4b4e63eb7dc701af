"""Queries over keyed lookups and writes, membership and edges."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsframe.operators import (
    add_members,
    associate,
    batch_ids,
    contact_lists,
    contact_rules,
    content_rules,
    delete_all,
    delete_keys,
    list_members,
    lookup_batch,
    masked_update,
    person_batch_rules,
    person_rules,
    property_updates,
    tag_rows,
    unmatched_keys,
    upsert,
    validate_rows,
)
from opsframe.plans.registry import query, table


def _contacts(spark, sf_dir):
    """Customers as contacts; every second segment has no email."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("vid"),
        F.concat(
            F.lower(F.translate("c_name", "#", ".")), F.lit("@example.com")
        ).alias("email"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )


@query(
    "lookup_batch",
    """
    SELECT c_custkey, c_name, c_mktsegment FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM orders
                        WHERE o_totalprice > 400000)
    """,
)
def _lookup_batch(spark, sf_dir):
    keys = (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_totalprice") > 400000)
        .select(F.col("o_custkey").alias("c_custkey"))
    )
    return lookup_batch(
        table(spark, sf_dir, "customer"),
        keys,
        "c_custkey",
        ["c_name", "c_mktsegment"],
    )


@query(
    "unmatched_keys",
    """
    SELECT DISTINCT l_orderkey + 300 AS o_orderkey FROM lineitem
    WHERE l_orderkey + 300 NOT IN (SELECT o_orderkey FROM orders)
    """,
)
def _unmatched_keys(spark, sf_dir):
    keys = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") + 300).alias("o_orderkey")
    )
    return unmatched_keys(table(spark, sf_dir, "orders"), keys, "o_orderkey")


@query(
    "upsert",
    """
    WITH updates AS (
      SELECT o_custkey * 2 AS vid, o_orderkey AS seq, o_orderstatus AS st,
             o_orderpriority AS pr
      FROM orders
    ), segment AS (
      SELECT vid, arg_max(pr, seq) AS segment
      FROM updates WHERE st <> 'P' GROUP BY vid
    ), cleared AS (
      SELECT vid, arg_max(st, seq) AS st
      FROM updates WHERE st <> 'F' GROUP BY vid
    ), u AS (
      SELECT coalesce(s.vid, c.vid) AS vid, s.vid IS NOT NULL AS has_segment,
             s.segment, c.st
      FROM segment s FULL JOIN cleared c ON s.vid = c.vid
    )
    SELECT coalesce(c.c_custkey, u.vid) AS vid, c.c_name AS name,
           CASE WHEN has_segment THEN u.segment ELSE c.c_mktsegment END
             AS segment,
           CASE u.st WHEN 'P' THEN NULL WHEN 'O' THEN 1.5
                ELSE c.c_acctbal END AS balance
    FROM customer c FULL JOIN u ON c.c_custkey = u.vid
    """,
)
def _upsert(spark, sf_dir):
    target = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("vid"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )

    def item(name, value):
        return F.struct(
            F.lit(name).alias("property"), value.alias("value")
        )

    status = F.col("o_orderstatus")
    # Status P sets the balance to NULL, O sets it, F does not name it.
    properties = F.array(
        F.when(status != "P", item("segment", F.col("o_orderpriority"))),
        F.when(
            status != "F",
            item("balance", F.when(status == "O", F.lit("1.5"))),
        ),
    )
    contacts = table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") * 2).alias("vid"),
        F.col("o_orderkey").alias("seq"),
        F.filter(properties, lambda p: p.isNotNull()).alias("properties"),
    )
    return upsert(
        target, property_updates(contacts, "vid", "seq"), "vid", ["seq", "pos"]
    )


@query(
    "upsert_by_either_key",
    """
    WITH contacts AS (
      SELECT c_custkey AS vid, 'c' || c_custkey AS email,
             c_mktsegment AS segment FROM customer
    ), updates AS (
      SELECT CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey * 2 END AS vid,
             'c' || (o_custkey * 2) AS email, o_orderkey AS seq,
             CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS value
      FROM orders
    ), placed AS (
      SELECT coalesce(u.vid, c.vid) AS vid, u.email, seq, value
      FROM updates u LEFT JOIN contacts c ON u.vid IS NULL AND u.email = c.email
    ), latest AS (
      SELECT vid, CASE WHEN vid IS NULL THEN email END AS email,
             arg_max(value, seq) AS value
      FROM placed GROUP BY 1, 2
    )
    SELECT c.vid, c.email, coalesce(l.value, c.segment) AS segment
    FROM contacts c LEFT JOIN latest l ON c.vid = l.vid
    UNION ALL
    SELECT vid, email, value FROM latest
    WHERE vid IS NULL OR vid NOT IN (SELECT vid FROM contacts)
    """,
)
def _upsert_by_either_key(spark, sf_dir):
    """Contacts named by id or else by email; orders of status P name theirs
    without any property."""
    target = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("vid"),
        F.concat(F.lit("c"), "c_custkey").alias("email"),
        F.col("c_mktsegment").alias("segment"),
    )
    named = F.struct(
        F.lit("segment").alias("property"),
        F.col("o_orderpriority").alias("value"),
    )
    twice = F.col("o_custkey") * 2
    contacts = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 3 != 0, twice).alias("vid"),
        F.concat(F.lit("c"), twice).alias("email"),
        F.col("o_orderkey").alias("seq"),
        F.filter(
            F.array(F.when(F.col("o_orderstatus") != "P", named)),
            lambda p: p.isNotNull(),
        ).alias("properties"),
    )
    changes = property_updates(contacts, ["vid", "email"], "seq")
    # The position is NULL for a contact without properties.
    return upsert(
        target, changes, "vid", ["seq"], other_key="email"
    )


@query(
    "masked_update",
    """
    WITH u AS (
      SELECT l_partkey, l_quantity AS size,
             CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS flag
      FROM lineitem WHERE l_linestatus = 'F'
      QUALIFY row_number() OVER (
        PARTITION BY l_partkey
        ORDER BY l_orderkey DESC, l_suppkey DESC, l_linenumber DESC,
                 l_quantity DESC, l_extendedprice DESC, l_returnflag DESC) = 1
    )
    SELECT p_partkey, p_name,
           CASE WHEN u.l_partkey IS NULL THEN p_brand ELSE u.flag END
             AS p_brand,
           CASE WHEN u.l_partkey IS NULL THEN p_size
                ELSE CAST(u.size AS INTEGER) END AS p_size,
           p_retailprice
    FROM part LEFT JOIN u ON p_partkey = u.l_partkey
    """,
)
def _masked_update(spark, sf_dir):
    target = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"
    )
    lines = table(spark, sf_dir, "lineitem").filter(
        F.col("l_linestatus") == "F"
    )
    updates = lines.select(
        F.col("l_partkey").alias("p_partkey"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias(
            "p_brand"
        ),
        F.col("l_quantity").cast("int").alias("p_size"),
        F.lit(0.0).alias("p_retailprice"),
        F.struct(
            "l_orderkey",
            "l_suppkey",
            "l_linenumber",
            "l_quantity",
            "l_extendedprice",
            "l_returnflag",
        ).alias("seq"),
    )
    return masked_update(
        target, updates, "p_partkey", mask=["p_brand", "p_size"], seq="seq"
    )


@query(
    "masked_update_nested",
    """
    SELECT c_custkey, c_name AS name,
           CASE WHEN s_suppkey IS NULL THEN c_nationkey ELSE s_nationkey END
             AS nation,
           CASE WHEN s_suppkey IS NULL OR s_acctbal <= 0
                THEN c_acctbal ELSE s_acctbal END AS balance
    FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey
    """,
)
def _masked_update_nested(spark, sf_dir):
    target = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.struct(
            F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")
        ).alias("profile"),
        F.col("c_acctbal").alias("balance"),
    )
    updates = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("c_custkey"),
        F.struct(
            F.lit("ignored").alias("name"),
            F.col("s_nationkey").alias("nation"),
        ).alias("profile"),
        F.col("s_acctbal").alias("balance"),
        F.when(F.col("s_acctbal") > 0, F.array(F.lit("balance")))
        .otherwise(F.array())
        .cast("array<string>")
        .alias("mask"),
    )
    with_nation = masked_update(
        target, updates, "c_custkey", mask=["profile.nation"]
    )
    own_masks = masked_update(
        with_nation,
        updates.select("c_custkey", "balance", "mask"),
        "c_custkey",
        mask_column="mask",
    )
    return own_masks.select("c_custkey", "profile.*", "balance")


@query(
    "delete_keys",
    """
    SELECT 'rest' AS part, s_suppkey FROM supplier
    WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem
                            WHERE l_extendedprice > 90000)
    UNION ALL
    SELECT 'removed', s_suppkey FROM supplier
    WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem
                        WHERE l_extendedprice > 90000)
    """,
)
def _delete_keys(spark, sf_dir):
    keys = (
        table(spark, sf_dir, "lineitem")
        .filter(F.col("l_extendedprice") > 90000)
        .select(F.col("l_suppkey").alias("s_suppkey"))
    )
    rest, removed = delete_keys(
        table(spark, sf_dir, "supplier"), keys, "s_suppkey"
    )
    return rest.select(
        F.lit("rest").alias("part"), "s_suppkey"
    ).unionByName(removed.select(F.lit("removed").alias("part"), "s_suppkey"))


@query(
    "delete_all",
    "SELECT o_orderkey, 0 AS rows_left FROM orders",
)
def _delete_all(spark, sf_dir):
    rest, removed = delete_all(table(spark, sf_dir, "orders"), "o_orderkey")
    left = rest.select("o_orderkey", F.lit(1).alias("rows_left"))
    return removed.select(
        "o_orderkey", F.lit(0).alias("rows_left")
    ).unionByName(left)


@query(
    "add_members",
    """
    SELECT DISTINCT list_id, vid FROM (
      SELECT c_mktsegment AS list_id, c_custkey AS vid FROM customer
      UNION ALL
      SELECT 'BUILDING', c_custkey FROM customer WHERE c_nationkey = 3
      UNION ALL
      SELECT 'BUILDING', o_custkey FROM orders WHERE o_totalprice > 450000
    )
    """,
)
def _add_members(spark, sf_dir):
    contacts = _contacts(spark, sf_dir)
    members = contacts.select(F.col("segment").alias("list_id"), "vid")
    emails = (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_nationkey") == 3)
        .select(
            F.concat(
                F.lower(F.translate("c_name", "#", ".")),
                F.lit("@example.com"),
            ).alias("email")
        )
    )
    vids = (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_totalprice") > 450000)
        .select(F.col("o_custkey").alias("vid"))
    )
    return add_members(members, "BUILDING", contacts, emails, vids)


@query(
    "list_members",
    """
    SELECT c_mktsegment AS list_id, c_custkey AS vid, c_acctbal AS balance
    FROM customer
    """,
)
def _list_members(spark, sf_dir):
    contacts = _contacts(spark, sf_dir)
    members = contacts.select(F.col("segment").alias("list_id"), "vid")
    return list_members(members, contacts, properties=["balance"])


@query(
    "list_members_of_one",
    """
    SELECT c_mktsegment AS list_id, c_custkey AS vid,
           lower(replace(c_name, '#', '.')) || '@example.com' AS email
    FROM customer WHERE c_mktsegment = 'FURNITURE'
    """,
)
def _list_members_of_one(spark, sf_dir):
    contacts = _contacts(spark, sf_dir)
    members = contacts.select(F.col("segment").alias("list_id"), "vid")
    return list_members(members, contacts, "FURNITURE", ["email"])


@query(
    "contact_lists",
    """
    SELECT c_mktsegment AS list_id, count(*) AS size
    FROM customer GROUP BY c_mktsegment
    """,
)
def _contact_lists(spark, sf_dir):
    contacts = _contacts(spark, sf_dir)
    return contact_lists(contacts.select(F.col("segment").alias("list_id")))


@query(
    "associate",
    """
    SELECT DISTINCT 'order' AS object_type,
           CAST(o_orderkey AS VARCHAR) AS object_id,
           'customer' AS to_object_type,
           CAST(o_custkey AS VARCHAR) AS to_object_id, kind
             AS association_type
    FROM (SELECT o_orderkey, o_custkey, 'placed_by' AS kind FROM orders
          UNION ALL
          SELECT o_orderkey, o_custkey, 'placed_by' FROM orders
          WHERE o_orderstatus = 'P'
          UNION ALL
          SELECT o_orderkey, o_custkey, 'paid_by' FROM orders
          WHERE o_orderstatus <> 'O')
    """,
)
def _associate(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")

    def edges(df, kind):
        return df.select(
            F.lit("order").alias("object_type"),
            F.col("o_orderkey").cast("string").alias("object_id"),
            F.lit("customer").alias("to_object_type"),
            F.col("o_custkey").cast("string").alias("to_object_id"),
            F.lit(kind).alias("association_type"),
        )

    status = F.col("o_orderstatus")
    added = edges(orders.filter(status == "P"), "placed_by").unionByName(
        edges(orders.filter(status != "O"), "paid_by")
    )
    return associate(edges(orders, "placed_by"), added)


@query(
    "batch_ids",
    """
    SELECT o_orderkey, o_orderdate,
           CAST((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1)
                // 1000 AS BIGINT) AS batch
    FROM orders
    """,
)
def _batch_ids(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return batch_ids(orders, 1000, ["o_orderdate", "o_orderkey"])


@query(
    "batch_ids_within",
    """
    SELECT o_orderkey, o_orderstatus,
           CAST((row_number() OVER (PARTITION BY o_orderstatus
                                    ORDER BY o_orderkey) - 1)
                // 100 AS BIGINT) AS batch
    FROM orders
    """,
)
def _batch_ids_within(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus"
    )
    return batch_ids(orders, 100, "o_orderkey", within=["o_orderstatus"])


@query(
    "validate_contacts",
    """
    SELECT reason, count(*) AS contacts FROM (
      SELECT unnest([reason FOR reason IN [
        CASE WHEN c_acctbal < 0 AND (c_nationkey = 1 OR c_nationkey = 2)
             THEN 'email or vid is required' END,
        CASE WHEN c_mktsegment = 'BUILDING'
             THEN 'property is required' END,
        CASE WHEN c_nationkey = 5 THEN 'value is required' END
      ] IF reason IS NOT NULL]) AS reason
      FROM customer)
    GROUP BY reason
    UNION ALL
    SELECT 'valid', count(*) FROM customer
    WHERE NOT (c_acctbal < 0 AND (c_nationkey = 1 OR c_nationkey = 2))
      AND c_mktsegment <> 'BUILDING' AND c_nationkey <> 5
    """,
)
def _validate_contacts(spark, sf_dir):
    nation = F.col("c_nationkey")
    contacts = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") >= 0, F.col("c_custkey").cast("string"))
        .alias("vid"),
        F.when(nation == 1, F.lit(""))
        .when(nation != 2, F.col("c_name"))
        .alias("email"),
        F.array(
            F.struct(
                F.when(
                    F.col("c_mktsegment") != "BUILDING", F.lit("segment")
                ).alias("property"),
                F.when(nation != 5, F.col("c_mktsegment")).alias("value"),
            )
        ).alias("properties"),
    )
    valid, rejected = validate_rows(contacts, contact_rules(contacts))
    reasons = (
        rejected.select(F.explode("reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("contacts"))
    )
    counted = valid.agg(F.count(F.lit(1)).alias("contacts")).select(
        F.lit("valid").alias("reason"), "contacts"
    )
    return reasons.unionByName(counted)


@query(
    "validate_content",
    """
    SELECT conv_id, turn,
           concat_ws(';',
             CASE WHEN role = 'system' AND length(text) % 2 = 0
                  THEN 'unknown category' END,
             CASE WHEN role = 'user' AND turn = 0 THEN 'body is required' END,
             CASE WHEN role = 'system' AND length(text) % 2 = 1
                  THEN 'list-picker needs items' END,
             CASE WHEN role = 'system' AND length(text) % 2 = 1
                  THEN 'list-picker needs button' END,
             CASE WHEN role = 'assistant' AND turn > 3
                  THEN 'reply needs actions' END) AS reasons
    FROM conversations
    """,
)
def _validate_content(spark, sf_dir):
    role, turn = F.col("role"), F.col("turn")
    actions = F.array(F.create_map(F.lit("id"), turn.cast("string")))
    content = table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.when(role == "user", "text")
        .when(role == "assistant", "call-to-action")
        .when(F.length("text") % 2 == 1, "list-picker")
        .otherwise("poll")
        .alias("category"),
        F.when(~((role == "user") & (turn == 0)), F.col("text")).alias("body"),
        F.when(turn > 3, F.slice(actions, 1, 0))
        .otherwise(actions)
        .alias("actions"),
        F.slice(actions, 1, 0).alias("items"),
        F.lit("").alias("button"),
    )
    return tag_rows(content, content_rules()).select(
        "conv_id", "turn", F.array_join("reasons", ";").alias("reasons")
    )


@query(
    "validate_persons",
    """
    SELECT c_custkey,
           concat_ws(';',
             CASE WHEN c_nationkey = 0 THEN 'names is required' END,
             CASE WHEN c_nationkey = 1
                  THEN 'names.givenName is required' END,
             CASE WHEN c_acctbal < 0
                  THEN 'phoneNumbers.value is required' END) AS reasons,
           concat_ws(';',
             CASE WHEN c_acctbal > 9000 THEN 'contactPerson is required' END,
             CASE WHEN c_acctbal <= 9000 AND c_nationkey = 0
                  THEN 'contactPerson.names is required' END,
             CASE WHEN c_acctbal <= 9000 AND c_nationkey = 1
                  THEN 'names.givenName is required' END) AS batch_reasons
    FROM customer
    """,
)
def _validate_persons(spark, sf_dir):
    nation = F.col("c_nationkey")
    given = F.struct(
        F.when(nation != 1, F.col("c_name")).alias("givenName")
    )
    nameless = F.struct(F.lit(None).cast("string").alias("givenName"))
    # Only the first name counts, so the second one may be empty.
    names = F.when(nation != 0, F.array(given, nameless))
    phone = F.when(F.col("c_acctbal") >= 0, F.lit("555"))
    persons = table(spark, sf_dir, "customer").select(
        "c_custkey",
        names.alias("names"),
        F.when(
            F.col("c_mktsegment").isNotNull(),
            F.array(F.struct(phone.alias("value"))),
        ).alias("phoneNumbers"),
        F.array(
            F.struct(
                F.when(
                    F.col("c_acctbal") <= 9000, F.struct(names.alias("names"))
                ).alias("contactPerson")
            )
        ).alias("contacts"),
    )
    tagged = tag_rows(persons, person_rules()).withColumnRenamed(
        "reasons", "_person"
    )
    return tag_rows(tagged, person_batch_rules()).select(
        "c_custkey",
        F.array_join("_person", ";").alias("reasons"),
        F.array_join("reasons", ";").alias("batch_reasons"),
    )
