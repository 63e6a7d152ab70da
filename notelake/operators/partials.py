"""Marts kept current by partial sums: a load adds the change of its notes, and only modified entities are made anew."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.layers import Layers
from .marts import TOP, ranked, with_closing_texts
from .update_log import UpdateLog

#: Parts of the sums, by hash of the entity; a refresh reads those of modified entities.
PARTS = 64
ENTITY = ["kind", "entity"]
CELL = [*ENTITY, "part", "year", "family", "key"]


class Sums(Layers):
    """Layers of counts: a reader adds up the rows of equal keys of all layers."""

    def _newest(self, layers: list[dict]) -> DataFrame:
        rows = reduce(DataFrame.unionByName, [self._frame(x, "rows") for x in layers])
        return rows.groupBy(*CELL).agg(F.sum("n").alias("n")).where("n <> 0")


def cells(f: DataFrame) -> DataFrame:
    """Counts from which marts are made, in long form: kind and entity, part, year, family, key, n.

    Families: actions, closed_with_comment, dates by action, hours of the week by action, tags, applications, and days to resolution
    (a histogram, so that medians are exact). All add up over notes; `f` must hold all facts of each note that it holds.
    """
    cell = lambda family, key, n=F.lit(1): F.struct((F.lit(family) if isinstance(family, str) else family).alias("family"), key.cast("string").alias("key"), n.cast("long").alias("n"))
    kind = "array<struct<family:string,key:string,n:bigint>>"
    families = F.array(
        cell("action", F.col("action")),
        F.when(F.col("texts") > 0, cell("closed_with_comment", F.lit(""), F.col("texts"))),
        cell(F.concat(F.lit("date "), F.col("action")), F.col("action_date")),
        cell(F.concat(F.lit("hour "), F.col("action")), F.col("action_how")),
        F.when(F.col("app").isNotNull(), cell("app", F.col("app"))),
        F.when(F.col("days_to_resolution").isNotNull(), cell("days", F.col("days_to_resolution"))),
    )
    tags = F.transform(F.filter("hashtags", lambda t: t != ""), lambda t: cell("tag", t))
    families = F.array_compact(F.concat(families.cast(kind), tags.cast(kind)))
    entities = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).cast("long").alias("entity")) for kind, c in (("country", "country"), ("user", "action_user"))])
    rows = with_closing_texts(f).select(F.explode(entities).alias("e"), F.year("action_date").alias("year"), families.alias("x")).select("e.*", "year", F.explode("x").alias("x"))
    part = F.pmod(F.xxhash64(*ENTITY), F.lit(PARTS)).cast("int")
    return rows.groupBy(*ENTITY, part.alias("part"), "year", F.col("x.family").alias("family"), F.col("x.key").alias("key")).agg(F.sum("x.n").alias("n"))


def yearly(c: DataFrame) -> DataFrame:
    """kind, entity, year: the five measures, and mean and median of days to resolution."""
    n = lambda family, key: F.coalesce(F.sum(F.when((F.col("family") == family) & (F.col("key") == key), F.col("n"))), F.lit(0))
    by = [*ENTITY, "year"]
    names = {"open": ("action", "opened"), "commented": ("action", "commented"), "closed": ("action", "closed"), "closed_with_comment": ("closed_with_comment", ""), "reopened": ("action", "reopened")}
    counts = c.where(F.col("family").isin("action", "closed_with_comment")).groupBy(*by).agg(*[n(*key).alias(name) for name, key in names.items()])
    d = c.where("family = 'days'").withColumn("days", F.col("key").cast("long"))
    w = Window.partitionBy(*by)
    d = d.withColumn("hi", F.sum("n").over(w.orderBy("days"))).withColumn("all", F.sum("n").over(w)).withColumn("lo", F.col("hi") - F.col("n"))
    at = lambda place: F.max(F.when((F.col("lo") <= place) & (place < F.col("hi")), F.col("days")))
    median = (at(F.floor((F.col("all") - 1) / 2)) + at(F.ceil((F.col("all") - 1) / 2))) / 2
    days = d.groupBy(*by).agg((F.sum(F.col("days") * F.col("n")) / F.sum("n")).alias("avg_days"), median.alias("median_days"))
    return counts.join(days, by, "left")


def tops(c: DataFrame) -> DataFrame:
    """kind, entity, family, key, n, rank: most used tags and busiest dates by opens and closes."""
    n = c.where(F.col("family").isin("tag", "date opened", "date closed")).groupBy(*ENTITY, "family", "key").agg(F.sum("n").alias("n"))
    return ranked(n, [*ENTITY, "family"], top=TOP)


def hours(c: DataFrame) -> DataFrame:
    """kind, entity, action, dow, hour, n: working hours by opens, comments and closes."""
    own = c.where(F.col("family").isin("hour opened", "hour commented", "hour closed")).groupBy(*ENTITY, F.substring("family", 6, 20).alias("action"), F.col("key").cast("int").alias("how")).agg(F.sum("n").alias("n"))
    return own.select(*ENTITY, "action", F.floor(F.col("how") / 100).cast("int").alias("dow"), (F.col("how") % 100).alias("hour"), "n")


def apps(c: DataFrame) -> DataFrame:
    """kind, entity, year, app, n, pct: applications and their share of the year."""
    n = c.where("family = 'app'").groupBy(*ENTITY, "year", F.col("key").alias("app")).agg(F.sum("n").alias("n"))
    return n.withColumn("pct", F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy(*ENTITY, "year")))


class Marts:
    """The sums and the marts of countries and users under a folder, kept current with a facts table."""

    MADE = {"yearly": yearly, "tops": tops, "hours": hours, "apps": apps}

    def __init__(self, spark: SparkSession, path: str):
        self.log = UpdateLog(spark, f"{path}/log")
        self.sums = Sums(spark, f"{path}/sums", ENTITY, by="part")
        self.marts = {name: Layers(spark, f"{path}/{name}", ENTITY) for name in self.MADE}

    def refresh(self, facts: Layers) -> bool:
        """Bring all up to the facts' snapshot of now; False if they were.

        The sums get the new counts of the notes that loads have changed since, less their old ones. Entities of those notes are modified: their sums alone are
        read, by parts, and their mart rows replaced. Each step is one commit that tells how far it is, so a refresh that dies is run again
        and goes on; it ends at the rows of a full build. Each step leaves a row in the log.
        """
        now, done = facts.snapshot(), self.sums.told("facts", 0)
        ids = facts.changed(done, now)
        if now["version"] != done and ids is not None:
            with self.log.update("sums") as update:
                new = cells(update.facts(facts.read(now).join(ids, "note_id", "left_semi")))
                layer = self.sums.begin()
                if done:
                    old = cells(facts.read(facts.snapshot(done)).join(ids, "note_id", "left_semi"))
                    new = new.unionByName(old.withColumn("n", -F.col("n"))).groupBy(*CELL).agg(F.sum("n").alias("n"))
                layer.write(update.rows(new).repartition("part"))  # a file for each part, not for each part and task
                layer.commit(facts=now["version"])
        sums, stale, read = self.sums.snapshot(), False, {}
        try:
            for name, mart in self.marts.items():
                since = mart.told("sums", 0)
                if since < sums["version"]:
                    if since not in read:
                        read[since] = self._since(since, sums)
                    modified, own = read[since]
                    if modified is not None:
                        stale = True
                        with self.log.update(name) as update:
                            layer = mart.begin()
                            if since:
                                layer.write(modified, "keys")
                            layer.write(update.rows(self.MADE[name](own)))
                            layer.commit(sums=sums["version"])
                        mart.compact()
        finally:
            for since, frames in read.items():
                for df in frames if since else ():
                    if df is not None:
                        df.unpersist()
        self.sums.compact()
        return stale

    def _since(self, since: int, sums: dict) -> tuple[DataFrame | None, DataFrame | None]:
        """Entities modified after a version of the sums, and their sums, kept for the marts that are made of them; before any version all, as they lie."""
        modified = self.modified(since, sums)
        if modified is None or not since:
            return modified, self.sums.read(sums) if modified is not None else None
        modified = modified.persist()
        return modified, self.of(modified, sums).persist()

    def modified(self, since: int, sums: dict | None = None) -> DataFrame | None:
        """Entities of the notes that changed after a version of the sums."""
        return self.sums.changed(since, sums)

    def years(self, since: int) -> DataFrame | None:
        """kind, entity, year: in which years the notes that changed after a version of the sums have facts; those are to be made anew."""
        later = [self.sums._frame(x, "rows") for x in self.sums.snapshot()["layers"] if x["version"] > since]
        return reduce(DataFrame.unionByName, later).select(*ENTITY, "year").distinct() if later else None

    def of(self, entities: DataFrame, sums: dict | None = None) -> DataFrame:
        """The sums of these entities; parts without one of them aren't read."""
        part = F.pmod(F.xxhash64(*ENTITY), F.lit(PARTS)).cast("int")
        parts = [r[0] for r in entities.select(part.alias("part")).distinct().collect()]  # PARTS at most
        return self.sums.read(sums).where(F.col("part").isin(parts)).join(entities, ENTITY, "left_semi")
