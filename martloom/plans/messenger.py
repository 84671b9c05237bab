"""Messenger vault and the conversion of the oldest groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martloom.functions.keys import known_uuid3
from martloom.operators.ordered import changes, hourly
from martloom.operators.vault import having_parents, hub, lineage, link, satellite
from martloom.session import stored


def event_changes(group_log: DataFrame, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """Group log without repeated events; a user who 'invited' themselves has no inviter.

    Events at one moment are ordered by event name.  ``parents`` maps key columns to
    tables of the known ones; they are looked up once per (user, group, hour).
    """
    hour = F.coalesce(hourly(F.col("event_dt")), F.lit("0001-01-01").cast("timestamp"))
    known = (lambda keys: having_parents(keys, parents)) if parents else None
    kept = changes(group_log, ["user_id", "group_id"], ["event_dt", "event"], "event", hour, known)
    return kept.withColumn("user_id_from", F.nullif("user_id_from", "user_id"))


def messenger_vault(
    users: DataFrame, groups: DataFrame, dialogs: DataFrame, group_log: DataFrame, load_dt, load_src: str = "s3",
    store_parents: bool = False,
) -> dict[str, DataFrame]:
    """All hubs, links and satellites by name.

    ``store_parents`` writes the hubs of users and groups once, for those who
    use several tables that depend on them.
    """
    load = lineage(load_dt, load_src)
    users = users.withColumnRenamed("id", "user_id")
    groups = groups.withColumnsRenamed({"id": "group_id", "admin_id": "user_id"})
    dialogs = dialogs.withColumns({
        "datetime": F.col("message_ts"), "user_id": F.col("message_from"), "group_id": F.col("message_group")})
    user, group, message = {"hk_user_id": "user_id"}, {"hk_group_id": "group_id"}, {"hk_message_id": "message_id"}

    t: dict[str, DataFrame] = {}
    t["hub_users"] = hub(users, "hk_user_id", "user_id", ["registration_dt"], load)
    t["hub_messages"] = hub(dialogs, "hk_message_id", "message_id", ["datetime"], load)
    t["hub_groups"] = hub(groups, "hk_group_id", "group_id", ["registration_dt"], load)
    if store_parents:
        t.update({name: stored(t[name], name) for name in ("hub_users", "hub_groups")})
    # A parent that comes from the same staging table exists by construction.  A hub holds
    # exactly the staged ids, so the ids are enough to know a parent.
    known_user, known_group = {"user_id": users}, {"group_id": groups}
    if store_parents:
        known_user, known_group = {"user_id": t["hub_users"]}, {"group_id": t["hub_groups"]}
    known_both = {**known_group, **known_user}

    t["link_admins"] = link(groups, "hk_l_admin_id", {**group, **user}, load, known_user)
    t["link_user_message"] = link(dialogs, "hk_l_user_message", {**user, **message}, load, known_user)
    t["link_group_message"] = link(dialogs, "hk_l_groups_dialogs", {**group, **message}, load, known_group)
    # The change filter keeps the first event of every user and group, so the
    # raw log has the same pairs as the cleaned one.
    t["link_user_group"] = link(group_log, "hk_l_user_group_activity", {**group, **user}, load, known_both)

    t["sat_admins"] = satellite(
        groups.withColumns({"is_admin": F.lit(True), "admin_from": F.col("registration_dt")}),
        {**group, **user}, ["is_admin", "admin_from"], load, known_user, link_key="hk_admin_id")
    t["sat_dialog"] = satellite(dialogs, message, ["message", "message_from", "message_to"], load)
    t["sat_socdem"] = satellite(users, user, ["country", "age"], load)
    t["sat_chatinfo"] = satellite(users, user, ["chat_name"], load)
    t["sat_group_name"] = satellite(groups, group, ["group_name"], load)
    t["sat_group_private"] = satellite(groups, group, ["is_private"], load)
    t["sat_auth_history"] = satellite(
        event_changes(group_log, known_both), {**group, **user}, ["user_id_from", "event", "event_dt"], load,
        link_key="hk_l_user_group_activity")
    return t


def oldest_groups(hub_groups: DataFrame, count: int = 10) -> DataFrame:
    """The groups registered first; ties go to the smaller id."""
    return hub_groups.orderBy("registration_dt", "group_id").limit(count)


def group_added_users(auth_history: DataFrame, link_user_group: DataFrame, chosen: DataFrame | None = None) -> DataFrame:
    """Distinct users added to each group."""
    links = link_user_group.select("hk_l_user_group_activity", "hk_group_id", "hk_user_id")
    if chosen is not None:
        links = links.join(chosen.select("hk_group_id"), "hk_group_id", "left_semi")
    added = auth_history.where("event = 'add'").select("hk_l_user_group_activity")
    # A link row is one (group, user), so counting the links that were ever
    # added counts distinct users without a second de-duplication.
    return (
        links.join(added, "hk_l_user_group_activity", "left_semi")
        .groupBy("hk_group_id").agg(F.count(F.lit(1)).alias("cnt_added_users")))


def group_active_users(
    link_group_message: DataFrame, link_user_message: DataFrame, chosen: DataFrame | None = None,
    members: DataFrame | None = None,
) -> DataFrame:
    """Distinct authors of messages in each group; only of ``members`` if given."""
    messages = link_group_message.select("hk_message_id", "hk_group_id")
    if chosen is not None:
        messages = messages.join(chosen.select("hk_group_id"), "hk_group_id", "left_semi")
    authors = messages.join(link_user_message.select("hk_message_id", "hk_user_id"), "hk_message_id")
    if members is not None:
        authors = authors.join(members, ["hk_group_id", "hk_user_id"], "left_semi")
    return authors.groupBy("hk_group_id").agg(
        F.count_distinct("hk_user_id").alias("cnt_users_in_group_with_messages"))


def group_conversion(vault: dict[str, DataFrame], count: int = 10, members_only: bool = False) -> DataFrame:
    """Active users per added user, for the oldest groups.

    Authors who never joined count too, as in the source view, so the ratio
    may exceed 1; ``members_only`` restricts it to users who were added.
    """
    chosen = oldest_groups(vault["hub_groups"], count)
    added = group_added_users(vault["sat_auth_history"], vault["link_user_group"], chosen)
    members = None
    if members_only:
        members = vault["link_user_group"].join(
            vault["sat_auth_history"].where("event = 'add'"), "hk_l_user_group_activity", "left_semi"
        ).select("hk_group_id", "hk_user_id")
    active = group_active_users(vault["link_group_message"], vault["link_user_message"], chosen, members)
    ratio: Column = F.col("cnt_users_in_group_with_messages") / F.col("cnt_added_users")
    return added.join(active, "hk_group_id", "left").withColumn("group_conversion", ratio).orderBy(
        F.desc("group_conversion"))


def staged_group_conversion(
    users: DataFrame, groups: DataFrame, dialogs: DataFrame, group_log: DataFrame, count: int = 10,
    members_only: bool = False,
) -> DataFrame:
    """``group_conversion`` straight from the staged tables, where the vault is not stored.

    The chosen groups go down to the scans, everything meets on business keys,
    and only the rows of the result are hashed.  Added and active users are
    one set of (group, user), so users are looked up once.
    """
    hub_groups = groups.where("id is not null").groupBy(F.col("id").alias("group_id")).agg(
        F.min("registration_dt").alias("registration_dt"))
    chosen = stored(oldest_groups(hub_groups, count).select("group_id"), "oldest_groups")
    added = (
        group_log.where("event = 'add' and user_id is not null").join(chosen, "group_id", "left_semi")
        .select("group_id", "user_id", F.lit(1).alias("added"), F.lit(0).alias("active")))
    written = dialogs.where("message_id is not null").select(
        "message_id", F.col("message_group").alias("group_id"), F.col("message_from").alias("user_id"))
    # The vault knows the group and the author of a message by two links, which meet on the message.
    active = (
        written.select("message_id", "group_id").join(chosen, "group_id", "left_semi")
        .join(written.where("user_id is not null").select("message_id", "user_id"), "message_id")
        .select("group_id", "user_id", F.lit(0).alias("added"), F.lit(1).alias("active")))
    pairs = (
        added.unionByName(active).groupBy("group_id", "user_id")
        .agg(F.max("added").alias("added"), F.max("active").alias("active"))
        .join(users.select(F.col("id").alias("user_id")), "user_id", "left_semi"))
    counted = F.col("active") * F.col("added") if members_only else F.col("active")
    return (
        pairs.groupBy("group_id").agg(
            F.sum("added").alias("cnt_added_users"),
            F.nullif(F.sum(counted), F.lit(0)).alias("cnt_users_in_group_with_messages"))
        .where("cnt_added_users > 0")
        .select(known_uuid3("group_id").alias("hk_group_id"), "cnt_added_users", "cnt_users_in_group_with_messages",
                (F.col("cnt_users_in_group_with_messages") / F.col("cnt_added_users")).alias("group_conversion"))
        .orderBy(F.desc("group_conversion")))
