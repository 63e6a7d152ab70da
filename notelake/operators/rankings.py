"""Rankings, tag analysis, badges and levels."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from .marts import count_of, is_

#: Places of a public ranking.
PLACES = 100


def users(f: DataFrame, action: str, cond: Column | None = None, top: int = PLACES) -> DataFrame:
    """Users by distinct notes of an action, comments by rows, with RANK; the last place is shared by all of its count."""
    rows = f.where(is_(action) & (F.col("action_user") != -1))
    rows = rows if cond is None else rows.where(cond)
    n = F.count("*") if action == "commented" else F.countDistinct("note_id")
    return placed(rows.groupBy("action_user").agg(n.alias("n")), top)


def countries(f: DataFrame, action: str, top: int | None = None) -> DataFrame:
    return placed(f.where(is_(action)).groupBy("country").agg(F.countDistinct("note_id").alias("n")), top)


def placed(counts: DataFrame, top: int | None = None, value: str = "n") -> DataFrame:
    """Rows with their RANK, all or those within the top. Only the distinct values are ordered in one task, not the rows."""
    values = counts.groupBy(value).agg(F.count("*").alias("_rows"))
    above = F.sum("_rows").over(Window.orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, -1))
    ranks = values.select(value, (F.coalesce(above, F.lit(0)) + 1).cast("int").alias("rank"))
    ranks = ranks if top is None else ranks.where(F.col("rank") <= top)
    return counts.join(ranks, value)


def period(name: str, as_of: date) -> Column | None:
    """The condition of a ranking's period; another name is an error."""
    d, at = F.col("action_date"), F.lit(as_of)
    known = {"all": None, "year": F.year(d) == F.year(at), "month": F.trunc(d, "month") == F.trunc(at, "month"), "today": d == at}
    if name not in known:
        raise ValueError(f"no such period: {name}")
    return known[name]


def users_document(f: DataFrame, name: str, as_of: date) -> DataFrame:
    """user, and the places among openers, closers and commenters of the period, in one row."""
    out = None
    for action in ("opened", "closed", "commented"):
        one = users(f, action, period(name, as_of)).select("action_user", F.col("rank").alias(f"{action}_rank"), F.col("n").alias(f"{action}_n"))
        out = one if out is None else out.join(one, "action_user", "full")
    return out


def tag_usage(t: DataFrame, actions: list[str] | None = None) -> DataFrame:
    """Uses of each tag, with countries, users, mean days to resolution and mean length of the texts."""
    rows = t if actions is None else t.where(F.col("action").isin(actions))
    return rows.groupBy("tag").agg(F.count("*").alias("uses"), F.countDistinct("country").alias("countries"), F.countDistinct("action_user").alias("users"), F.avg("days_to_resolution").alias("avg_days"), F.avg("comment_length").alias("avg_length"))


def tag_actions(t: DataFrame, by: list[str]) -> DataFrame:
    """Uses by action and distinct notes of each tag."""
    return t.groupBy(*by).agg(*[count_of(is_(a)).alias(a) for a in ("opened", "commented", "closed", "reopened")], F.countDistinct("note_id").alias("notes"))


def tag_bands(t: DataFrame, e: str) -> DataFrame:
    """Uses by place in the note's tags: first, second, 3-5, 6-10, later."""
    band = F.when(F.col("position") == 1, "1").when(F.col("position") == 2, "2").when(F.col("position") <= 5, "3-5").when(F.col("position") <= 10, "6-10").otherwise("11+")
    return t.groupBy(e, band.alias("band")).agg(F.count("*").alias("n"), F.avg("position").alias("mean_position"))


def tag_notes(f: DataFrame, t: DataFrame, e: str, tag: str, limit: int = 50) -> DataFrame:
    """Notes of each entity with a tag, whatever its case; the newest first, `limit` of each."""
    hit = t.where(F.lower("tag") == tag.lower()).select("note_id", "seq").distinct()
    w = Window.partitionBy(e).orderBy(F.desc("action_at"), F.desc("note_id"), F.desc("seq"))
    return f.join(hit, ["note_id", "seq"]).withColumn("place", F.row_number().over(w)).where(F.col("place") <= limit).select(e, "place", "note_id", "seq", "action", "action_at")


def frequent_pairs(t: DataFrame, least: int = 3) -> DataFrame:
    """rare, common: the pairs of tags of each note, of tags that are in `least` notes or more, dealt by the rarer of the two.

    A pair is in no more notes than its rarer tag, so tags of fewer notes go before any pair is made, and with them what one note's own
    tags would make; those of equal numbers go by name.
    """
    own = t.select("note_id", "tag").distinct()
    often = own.groupBy("tag").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    kept = own.join(often, "tag")
    rare = kept.select("note_id", F.struct("n", "tag").alias("rare"))
    return rare.join(kept.select("note_id", F.struct("n", "tag").alias("common")), "note_id").where("rare < common").select(F.col("rare.tag").alias("rare"), F.col("common.tag").alias("common"))


def tag_pairs(t: DataFrame, least: int = 3, top: int = 50) -> DataFrame:
    """Unordered pairs of tags of one note, by number of notes; those of `least` and more."""
    n = frequent_pairs(t, least).groupBy("rare", "common").agg(F.count("*").alias("notes")).where(F.col("notes") >= least)
    return n.select(F.least("rare", "common").alias("a"), F.greatest("rare", "common").alias("b"), "notes").orderBy(F.desc("notes"), "a", "b").limit(top)


#: Badges in their order, by measure and least value.
BADGES = [
    ("First Note", "opened", 1), ("First Close", "closed", 1), ("First Comment", "commented", 1),
    ("10 Notes Opened", "opened", 10), ("50 Notes Opened", "opened", 50), ("100 Notes Opened", "opened", 100), ("500 Notes Opened", "opened", 500), ("1000 Notes Opened", "opened", 1000),
    ("10 Notes Closed", "closed", 10), ("50 Notes Closed", "closed", 50), ("100 Notes Closed", "closed", 100), ("500 Notes Closed", "closed", 500), ("1000 Notes Closed", "closed", 1000),
    ("100 Comments", "commented", 100), ("500 Comments", "commented", 500), ("1000 Comments", "commented", 1000),
    ("Daily Contributor", "day_run", 7), ("Weekly Contributor", "week_run", 4), ("Monthly Contributor", "month_run", 3), ("Consistent Helper", "close_run", 30),
    ("Speed Demon", "speedy", 1), ("Problem Solver", "closed_with_comment", 10), ("Community Helper", "closed_with_comment", 50), ("Resolution Master", "closed_with_comment", 100),
    ("Hashtag Enthusiast", "tagged", 50), ("Mobile User", "mobile", 100), ("Desktop Power User", "desktop", 100),
    ("Early Adopter", "early", 1), ("Long Time Helper", "years", 5), ("Century Club", "year_opened", 100), ("Resolution Champion", "year_closed", 100), ("Comment King", "year_commented", 100),
    ("Perfect Week", "day_run", 7), ("Perfect Month", "day_run", 30),
    ("Quality Contributor", "avg_length", 50), ("Detail Oriented", "avg_length", 200), ("Collaborative", "mentions", 20), ("Resourceful", "urls", 20),
    ("Note Master", "opened", 5000), ("Resolution Legend", "closed", 5000), ("Comment Legend", "commented", 5000), ("All Around Helper", "all_round", 1000),
]


def measures(f: DataFrame, as_of: date) -> DataFrame:
    """user, measure, value: what badges go by, in long form."""
    year = F.year("action_date") == as_of.year
    fast = is_("closed") & (F.col("action_at") <= F.col("opened_at") + F.expr("INTERVAL 1 HOUR"))
    g = f.groupBy("action_user").agg(
        count_of(is_("opened")).alias("opened"), count_of(is_("closed")).alias("closed"), count_of(is_("commented")).alias("commented"),
        count_of(is_("closed") & (F.col("comment_length") > 0)).alias("closed_with_comment"), count_of(F.size("hashtags") > 0).alias("tagged"), count_of(F.col("has_mention")).alias("mentions"), count_of(F.col("has_url")).alias("urls"),
        count_of(C.is_mobile(F.col("platform"))).alias("mobile"), count_of(C.is_desktop(F.col("platform"))).alias("desktop"),
        count_of(is_("opened") & year).alias("year_opened"), count_of(is_("closed") & year).alias("year_closed"), count_of(is_("commented") & year).alias("year_commented"),
        F.coalesce(F.floor(F.avg("comment_length")), F.lit(0)).alias("avg_length"), F.coalesce(as_of.year - F.year(F.min(F.when(is_("opened"), F.col("action_date")))), F.lit(0)).cast("long").alias("years"),
        count_of(is_("opened") & (F.year("action_date") == 2013)).alias("early"), count_of(fast).alias("speedy"),
    ).withColumn("all_round", F.least("opened", "closed", "commented"))
    g = g.join(runs(f), "action_user", "left")
    names = [c for c in g.columns if c != "action_user"]
    return g.select("action_user", F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.coalesce(F.col(c).cast("long"), F.lit(0)).alias("value")) for c in names])).alias("m")).select("action_user", "m.*")


#: Runs by name: unit of time and the actions that count.
RUNS = {"day_run": ("day", ("opened", "closed")), "close_run": ("day", ("closed",)), "week_run": ("week", ("opened", "closed")), "month_run": ("month", ("opened", "closed"))}


def _unit(unit: str) -> Column:
    """The number of the day, week or month of the action."""
    d = F.col("action_date")
    return {"day": F.unix_date(d), "week": F.floor((F.unix_date(d) + 3) / 7), "month": F.year(d) * 12 + F.month(d)}[unit].cast("long")


def runs(f: DataFrame) -> DataFrame:
    """Longest runs of each user, a column for each of RUNS, from one pass: first the distinct units of every run, then its islands."""
    kinds = [F.when(F.col("action").isin(*only), F.struct(F.lit(name).alias("run"), _unit(unit).alias("i"))) for name, (unit, only) in RUNS.items()]
    on = f.where(F.col("action").isin("opened", "closed")).select("action_user", F.explode(F.array_compact(F.array(*kinds))).alias("k")).select("action_user", "k.*").distinct()
    island = F.col("i") - F.row_number().over(Window.partitionBy("action_user", "run").orderBy("i"))
    longest = on.withColumn("island", island).groupBy("action_user", "run", "island").agg(F.count("*").alias("n"))
    return longest.groupBy("action_user").agg(*[F.max(F.when(F.col("run") == name, F.col("n"))).alias(name) for name in RUNS])


def longest_run(f: DataFrame, unit: str, name: str) -> DataFrame:
    """Longest run of consecutive days, weeks or months with an action of each user."""
    on = f.select("action_user", _unit(unit).alias("i")).distinct()
    island = F.col("i") - F.row_number().over(Window.partitionBy("action_user").orderBy("i"))
    return on.withColumn("island", island).groupBy("action_user", "island").agg(F.count("*").alias("n")).groupBy("action_user").agg(F.max("n").alias(name))


def badges(f: DataFrame, as_of: date, spark: SparkSession) -> DataFrame:
    """user, badge: every badge whose measure is reached. The table of badges is fixed and broadcast."""
    rules = spark.createDataFrame(BADGES, "badge string, measure string, least long")
    return measures(f, as_of).where("action_user <> -1").join(F.broadcast(rules), "measure").where("value >= least").select("action_user", "badge")


def awards(f: DataFrame, as_of: date, spark: SparkSession) -> DataFrame:
    """user, badge, awarded_on: the first day up to as_of at whose end the user's facts so far reach the badge.

    One pass over the facts, whatever the number of days: first the counts of each user and day, a column for each measure. These narrow rows are
    dealt by user, and only there they become a row for each measure (of runs for each unit of time), so no later step shuffles. Then running values in
    that order: counts so far, counts so far in the year, the mean so far, and places within islands of consecutive units. A badge's day is
    the first whose value is enough; all three actions' for the one that asks for them; the New Year after so many years for the one of years.
    """
    opened, closed, commented, day = is_("opened"), is_("closed"), is_("commented"), F.unix_date("action_date").cast("long")
    fast = closed & (F.col("action_at") <= F.col("opened_at") + F.expr("INTERVAL 1 HOUR"))
    year = F.year("action_date").cast("long")
    counted = {
        "opened": opened, "closed": closed, "commented": commented, "closed_with_comment": closed & (F.col("comment_length") > 0), "tagged": F.size("hashtags") > 0, "mentions": F.col("has_mention"), "urls": F.col("has_url"),
        "mobile": C.is_mobile(F.col("platform")), "desktop": C.is_desktop(F.col("platform")), "early": opened & (year == 2013), "speedy": fast, "avg_length": F.col("comment_length").isNotNull(),
    }
    known = f.where((F.col("action_date") <= F.lit(as_of)) & (F.col("action_user") != -1))
    days = known.groupBy("action_user", "action_date").agg(*[count_of(cond).alias(name) for name, cond in counted.items()], F.sum("comment_length").alias("length"))
    # as many parts as it says: by the bytes of these rows Spark would make too few for what comes of them
    days = days.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "action_user")
    entry = lambda n, name, span, unit: F.when(n > 0, F.struct(F.lit(name).alias("measure"), span.cast("long").alias("span"), unit.cast("long").alias("unit"), n.alias("n")))
    entries = [entry(F.col(name), name, F.lit(0), day) for name in counted]
    entries += [entry(F.col(name), f"year_{name}", year, day) for name in ("opened", "closed", "commented")]
    entries += [entry(sum((F.col(a) for a in only), F.lit(0).cast("long")), name, F.lit(0), _unit(unit)) for name, (unit, only) in RUNS.items()]
    rows = days.select("action_user", "action_date", "length", F.explode(F.array_compact(F.array(*entries))).alias("m"))
    by = ["action_user", "measure", "span"]
    units = rows.select("action_user", "m.*", "action_date", "length").groupBy(*by, "unit").agg(F.min("action_date").alias("on"), F.sum("n").alias("n"), F.sum("length").alias("length"))
    so_far = Window.partitionBy(*by).orderBy("unit").rowsBetween(Window.unboundedPreceding, 0)
    told = units.withColumns({"n": F.sum("n").over(so_far), "length": F.sum("length").over(so_far), "island": F.col("unit") - F.row_number().over(Window.partitionBy(*by).orderBy("unit"))})
    told = told.withColumn("place", F.row_number().over(Window.partitionBy(*by, "island").orderBy("unit")))
    value = F.when(F.col("measure").isin(*RUNS), F.col("place")).when(F.col("measure") == "avg_length", F.floor(F.col("length") / F.col("n"))).otherwise(F.col("n"))
    rules = [(b, m, least, 1, 0) for b, m, least in BADGES if m not in ("all_round", "years")]
    rules += [(b, each, least, 3, 0) for b, m, least in BADGES if m == "all_round" for each in ("opened", "closed", "commented")]
    rules += [(b, "opened", 1, 1, least) for b, m, least in BADGES if m == "years"]
    fixed = F.broadcast(spark.createDataFrame(rules, "badge string, measure string, least long, needs int, years int"))
    on = F.when(F.col("years") > 0, F.make_date(F.year("on") + F.col("years"), F.lit(1), F.lit(1))).otherwise(F.col("on"))
    crossed = told.withColumn("value", value).join(fixed, "measure").where("value >= least").groupBy("action_user", "badge", "needs", "measure").agg(F.min(on).alias("on"))
    return crossed.groupBy("action_user", "badge", "needs").agg(F.max("on").alias("awarded_on"), F.count("*").alias("met")).where((F.col("met") == F.col("needs")) & (F.col("awarded_on") <= F.lit(as_of))).select("action_user", "badge", "awarded_on")


#: Levels by notes opened, notes closed and days from first to last action.
LEVELS = [("newcomer", 0, 0, 0), ("beginner", 1, 0, 1), ("intermediate", 11, 5, 30), ("advanced", 51, 25, 90), ("expert", 201, 100, 180), ("master", 500, 300, 365), ("legend", 1000, 600, 730)]


def experience(f: DataFrame) -> DataFrame:
    """Highest level whose three minimums hold, and closes for each opening in per cent, at most 100."""
    span = F.floor((F.unix_micros(F.max("action_at").cast("timestamp")) - F.unix_micros(F.min("action_at").cast("timestamp"))) / 86400e6)
    g = f.groupBy("action_user").agg(count_of(is_("opened")).alias("opened"), count_of(is_("closed")).alias("closed"), span.alias("days"))
    level = F.lit(LEVELS[0][0])
    for name, o, c, d in LEVELS[1:]:
        level = F.when((F.col("opened") >= o) & (F.col("closed") >= c) & (F.col("days") >= d), name).otherwise(level)
    ratio = F.when(F.col("opened") > 0, F.least(F.round(F.lit(100.0) * F.col("closed") / F.col("opened"), 2), F.lit(100.0))).otherwise(0.0)
    return g.select("action_user", "opened", "closed", "days", ratio.alias("ratio"), level.alias("level"))


def automation(f: DataFrame, as_of: date) -> DataFrame:
    """Score of four criteria over windows before as_of, and the level: velocity and geography by opener, the rest by actor."""
    now = F.lit(str(as_of)).cast("timestamp_ntz")
    ago = lambda n, unit: F.col("action_at") > now - F.expr(f"INTERVAL {n} {unit}")
    span = (F.unix_micros(F.max("action_at").cast("timestamp")) - F.unix_micros(F.min("action_at").cast("timestamp"))) / 1e6
    day = f.where(ago(24, "HOUR"))
    v = day.groupBy(F.col("opened_user").alias("u")).agg(count_of(is_("opened")).alias("n"), (span / 60).alias("s"))
    rate = F.col("n") / F.col("s")
    v = v.where("n > 5 AND s > 0").select("u", (0.25 * F.when(rate > 10, 0.8).when(rate > 5, 0.6).when(rate > 2, 0.3).otherwise(0.0)).alias("velocity"))
    g = day.where(is_("opened")).groupBy(F.col("opened_user").alias("u")).agg(F.countDistinct("country").alias("n"), (span / 3600).alias("s"))
    c, s = F.col("n"), F.col("s")
    g = g.where("n > 1 AND s > 0").select("u", (0.20 * F.when((c > 5) & (s < 6), 0.7).when((c > 3) & (s < 12), 0.5).when((c > 2) & (s < 24), 0.2).otherwise(0.0)).alias("geography"))
    t = f.where(ago(7, "DAY")).groupBy(F.col("action_user").alias("u"), "action_date").agg(F.countDistinct("action_how").alias("h")).groupBy("u").agg(F.avg("h").alias("h"), F.count("*").alias("d"))
    t = t.where("h > 20 AND d >= 5").select("u", (0.20 * F.when(F.col("h") > 22, 0.6).otherwise(0.4)).alias("temporal"))
    a = f.where(ago(30, "DAY")).groupBy(F.col("action_user").alias("u")).agg(count_of(is_("opened")).alias("o"), count_of(is_("commented")).alias("c"), F.count("*").alias("n"))
    o, m = 100.0 * F.col("o") / F.col("n"), 100.0 * F.col("c") / F.col("n")
    a = a.where("n > 20").select("u", (0.35 * F.when((o > 90) & (m < 5), 0.5).when((o > 80) & (m < 10), 0.3).otherwise(0.0)).alias("mix"))
    out = f.select(F.col("action_user").alias("u")).distinct()
    for part in (v, g, t, a):
        out = out.join(part, "u", "left")
    score = sum((F.coalesce(x, F.lit(0.0)) for x in ("velocity", "geography", "temporal", "mix")), F.lit(0.0))
    level = lambda s: F.when(s >= 0.8, 5).when(s >= 0.6, 4).when(s >= 0.4, 3).when(s >= 0.2, 2).otherwise(1)
    parts = [F.coalesce(x, F.lit(0.0)).alias(x) for x in ("velocity", "geography", "temporal", "mix")]
    return out.select(F.col("u").alias("action_user"), *parts, F.round(score, 4).alias("score"), level(score).alias("level"))


def contributions(f: DataFrame) -> DataFrame:
    """Users by number of actions, in bands, with shares of users and of actions."""
    n = f.groupBy("action_user").agg(F.count("*").alias("n"))
    band = F.when(F.col("n") == 1, "1")
    for low, high in ((2, 5), (6, 10), (11, 50), (51, 100), (101, 500), (501, 1000)):
        band = band.when(F.col("n") <= high, f"{low}-{high}")
    g = n.groupBy(band.otherwise("1000+").alias("band")).agg(F.count("*").alias("users"), F.sum("n").alias("actions"))
    every = Window.partitionBy()
    return g.select("band", "users", "actions", (F.lit(100.0) * F.col("users") / F.sum("users").over(every)).alias("user_pct"), (F.lit(100.0) * F.col("actions") / F.sum("actions").over(every)).alias("action_pct"))
