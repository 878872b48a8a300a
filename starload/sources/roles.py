"""The driver's TPC-H-like tables cast into warehouse roles (test fixtures).

Team = nation, player = supplier, game = order, player-game stats = line item.
These frames only give rows in the schemas the operators expect; all of the
warehouse work is done by the operators on them. Surrogate keys of the mapped
dimensions are natural key + 1000.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _by_key(arr):
    """Sort an array of ``struct(k, e)`` by ``k`` (``e`` may hold variants, which have no ordering)."""
    return F.array_sort(arr, lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0))


#: Line items of a task that groups or joins them by game.
TASK_LINES = 200_000


class Roles:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def team(self) -> DataFrame:
        n, r = self.table("nation"), self.table("region")
        return n.join(r, n.n_regionkey == r.r_regionkey).select(
            n.n_nationkey.alias("team_id"), (n.n_nationkey + 1000).alias("team_key"),
            n.n_name.alias("team_name"), r.r_name.alias("conference"))

    @cached_property
    def player(self) -> DataFrame:
        s = self.table("supplier")
        k = F.col("s_suppkey")
        return s.select(k.alias("player_id"), (k + 1000).alias("player_key"), F.col("s_nationkey").alias("team_id"),
                        F.col("s_name").alias("full_name"),
                        F.when(k % 3 == 0, "D").when(k % 3 == 1, "C").otherwise("G").alias("position_code"))

    @cached_property
    def game(self) -> DataFrame:
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
        c = self.table("customer").select("c_custkey", "c_nationkey")
        d = F.col("o_orderdate").cast("date")
        ok, ck, st = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
        return o.join(c, o.o_custkey == c.c_custkey).select(
            ok.alias("game_id"), (ok + 1000).alias("game_key"), d.alias("game_date"),
            F.when(F.month(d) >= 9, F.year(d)).otherwise(F.year(d) - 1).cast("string").alias("season"),
            F.col("o_orderpriority").alias("game_type"), F.col("c_nationkey").alias("home_team_id"),
            ((ok + ck) % 25).cast("int").alias("away_team_id"),
            F.when(st == "P", None).otherwise((ok % 7).cast("int")).alias("home_goals"),
            F.when(st == "P", None).otherwise((ck % 7).cast("int")).alias("away_goals"),
            (20 + ok % 20).cast("int").alias("home_shots"), (20 + ck % 20).cast("int").alias("away_shots"),
            F.when(st == "P", "FUT").when(st == "F", "FINAL").otherwise("OFF").alias("game_state"))

    @cached_property
    def stats_all(self) -> DataFrame:
        li = self.table("lineitem")
        return li.select(F.col("l_orderkey").alias("game_id"), F.col("l_suppkey").alias("player_id"),
                         (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("raw_id"), "l_partkey",
                         "l_linenumber", F.col("l_quantity").cast("int").alias("qty"), "l_returnflag",
                         "l_linestatus")

    @cached_property
    def stats(self) -> DataFrame:
        """Stats per (game, player). Penalty minutes are NULL when a line has return flag 'A', ice time is
        set only when a line has status 'F' (fixed-width tests, so the grouping is a hash aggregate).

        Lines are dealt by game once, in parts of about ``TASK_LINES`` lines whatever the table's size: the grouping
        and the joins by game that follow need no shuffle of their own, and a task's memory does not grow."""
        parts = max(self.spark.sparkContext.defaultParallelism, -(-self.table("lineitem").count() // TASK_LINES))
        return self.stats_all.repartition(parts, "game_id").groupBy("game_id", "player_id").agg(
            (F.min("qty") % 4).cast("int").alias("goals"), (F.min("l_linenumber") % 3).cast("int").alias("assists"),
            (F.max("qty") % 9).cast("int").alias("shots"), (F.min("l_partkey") % 5).cast("int").alias("hits"),
            (F.max("l_partkey") % 4).cast("int").alias("blocks"),
            F.when(F.max((F.col("l_returnflag") == "A").cast("int")) == 1, None).otherwise(F.lit(2))
            .alias("penalty_minutes"),
            F.when(F.max((F.col("l_linestatus") == "F").cast("int")) == 1, (600 + F.min("l_partkey") % 900)
                   .cast("int")).alias("time_on_ice_seconds"))

    @cached_property
    def stats_fact(self) -> DataFrame:
        """Stats in the fact's shape: the player's team, zero for NULL measures, stored points."""
        p = self.player.select("player_id", "team_id")
        s = self.stats.join(p, "player_id")
        zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("goals", "assists", "penalty_minutes")}
        return s.select("game_id", "player_id", "team_id", zero["goals"].alias("goals"),
                        zero["assists"].alias("assists"), (zero["goals"] + zero["assists"]).alias("points"),
                        "shots", "hits", "blocks", zero["penalty_minutes"].alias("penalty_minutes"),
                        "time_on_ice_seconds")

    @cached_property
    def team_src(self) -> DataFrame:
        t, k = self.team, F.col("team_id")
        return t.select("team_id",
                        F.when(k % 5 == 0, F.concat("team_name", F.lit("_X"))).when(k % 5 == 4, F.lit(None))
                        .otherwise(F.col("team_name")).cast("string").alias("team_name"),
                        F.when(k % 5 == 1, F.lit("")).otherwise(F.col("conference")).alias("conference"))

    @cached_property
    def team_tgt(self) -> DataFrame:
        t, k = self.team, F.col("team_id")
        return t.filter(k < 20).select(
            "team_id", "team_key", "team_name",
            F.when(k % 5 == 1, F.lit(None)).otherwise(F.col("conference")).cast("string").alias("conference"),
            (k != 7).alias("is_active"))

    @cached_property
    def player_src(self) -> DataFrame:
        """Staged players: names split from the supplier name; full name blank on every 5th, NULL on every 11th."""
        p, k = self.player, F.col("player_id")
        return p.select("player_id", "team_id",
                        F.split_part("full_name", F.lit("#"), F.lit(1)).alias("first_name"),
                        F.split_part("full_name", F.lit("#"), F.lit(2)).alias("last_name"),
                        F.when(k % 5 == 0, F.lit("")).when(k % 11 == 0, F.lit(None))
                        .otherwise(F.col("full_name")).cast("string").alias("full_name"),
                        "position_code")

    @cached_property
    def player_tgt(self) -> DataFrame:
        """Existing player dimension: every 7th player missing, every 4th with an old name."""
        p, k = self.player, F.col("player_id")
        return p.filter(k % 7 != 0).select(
            "player_id", "player_key", (F.col("team_id") + 1000).alias("team_key"),
            F.when(k % 4 == 0, F.concat("full_name", F.lit(" old"))).otherwise(F.col("full_name")).alias("full_name"),
            "position_code", F.lit(True).alias("is_active"))

    @cached_property
    def stats_staged(self) -> DataFrame:
        """Staged stats: measures as delivered (NULLs kept) with the player's team id."""
        return self.stats.join(self.player.select("player_id", "team_id"), "player_id")

    @cached_property
    def game_fact_existing(self) -> DataFrame:
        """Games already in the fact: the finished orders ('F'), keyed natural key + 1000."""
        o = self.table("orders").filter(F.col("o_orderstatus") == "F")
        return o.select(F.col("o_orderkey").alias("game_id"), (F.col("o_orderkey") + 1000).alias("game_key"))

    @cached_property
    def stats_fact_existing(self) -> DataFrame:
        """Stats already in the fact: those of the finished games, with keys as in the dimensions."""
        s = self.stats_staged.join(self.game_fact_existing, "game_id")
        return s.select((F.col("game_key") * 1000000 + F.col("player_id")).alias("player_game_stats_key"), "game_key",
                        (F.col("player_id") + 1000).alias("player_key"), (F.col("team_id") + 1000).alias("team_key"))

    # ---- landed payloads (one JSON document per row: payload key columns + raw text) ----------

    @cached_property
    def teams_payload(self) -> DataFrame:
        """Teams documents ``{data: [...]}`` per conference and block of 1024 team ids (bounded size).

        Codes are 'T' + (id % 16), so later teams repeat earlier codes; id % 5 = 3 has
        an empty ``triCode`` and a lower-case ``rawTricode``; id % 5 = 4 has no code.
        """
        k, name = F.col("team_id"), F.col("team_name")
        code = F.concat(F.lit("T"), F.lpad((k % 16).cast("string"), 2, "0"))
        elem = F.struct(
            k.alias("id"), name.alias("fullName"),
            F.when(k % 5 == 3, F.lit("")).when(k % 5 == 4, F.lit(None)).otherwise(code).alias("triCode"),
            F.when(k % 5 == 3, F.lower(code)).alias("rawTricode"),
            F.col("conference").alias("conferenceName"))
        data = self.team.groupBy("conference", F.floor(k / 1024).alias("chunk")).agg(
            _by_key(F.collect_list(F.struct(k.alias("k"), elem.alias("e")))).alias("a"))
        return data.select(F.concat(F.lit("teams/"), F.col("conference"), F.lit("-"),
                                    F.lpad(F.col("chunk").cast("string"), 10, "0"), F.lit(".json")).alias("path"),
                           F.to_json(F.struct(F.transform("a", lambda x: x["e"]).alias("data"))).alias("raw"))

    @cached_property
    def player_elements(self) -> DataFrame:
        """Roster entries: localized first names, last names as plain text on even ids."""
        p, k = self.player, F.col("player_id")
        first = F.split_part("full_name", F.lit("#"), F.lit(1))
        last = F.split_part("full_name", F.lit("#"), F.lit(2))
        first_v = F.when(k % 11 != 0, F.to_variant_object(F.struct(first.alias("default"))))
        last_v = F.when(k % 2 == 0, last.cast("variant")).otherwise(
            F.to_variant_object(F.struct(last.alias("default"))))
        birth = F.date_format(F.date_add(F.lit("1980-01-01").cast("date"), (k % 7000).cast("int")), "yyyy-MM-dd")
        elem = F.struct(k.alias("id"), first_v.alias("firstName"), last_v.alias("lastName"),
                        F.col("position_code").alias("positionCode"),
                        F.when(k % 2 == 0, "L").otherwise("R").alias("shootsCatches"),
                        F.when(k % 3 == 0, F.concat(birth, F.lit("T00:00:00"))).otherwise(birth).alias("birthDate"))
        return p.select("team_id", "player_id", "position_code", elem.alias("e"))

    @cached_property
    def roster_payloads(self) -> DataFrame:
        """Roster documents per team and id block (bounded size); goalies is a string for team % 7 = 3."""
        e = self.player_elements.withColumn("chunk", F.floor(F.col("player_id") / 1024))

        def group(code):
            return _by_key(F.collect_list(F.when(F.col("position_code") == code,
                                                 F.struct(F.col("player_id").alias("k"), F.col("e").alias("e")))))

        g = e.groupBy("team_id", "chunk").agg(group("C").alias("f"), group("D").alias("d"), group("G").alias("g"))
        goalies = F.when(F.col("team_id") % 7 == 3, F.lit("n/a").cast("variant")).otherwise(
            F.to_variant_object(F.transform("g", lambda x: x["e"])))
        doc = F.struct(F.transform("f", lambda x: x["e"]).alias("forwards"),
                       F.transform("d", lambda x: x["e"]).alias("defensemen"), goalies.alias("goalies"))
        return g.select("team_id", F.concat(F.lit("roster/"), F.col("team_id").cast("string"), F.lit("/"),
                                            F.col("chunk").cast("string"), F.lit(".json")).alias("path"),
                        F.to_json(doc).alias("raw"))

    @cached_property
    def schedule_payloads(self) -> DataFrame:
        """Schedule documents ``{gameWeek: [day, junk...]}`` per game date and id block.

        Request 0 holds every game; request 1 repeats games with id % 13 = 0 as type
        'LATE' (overlapping windows, the later request wins). Each document also
        carries a day without a date and a non-object day, which must be skipped.
        Games with id % 97 = 0 have no home team object.
        """
        g, k = self.game, F.col("game_id")
        side = lambda t: F.struct(F.col(f"{t}_team_id").alias("id"), F.col(f"{t}_goals").alias("score"),
                                  F.col(f"{t}_shots").alias("sog"))
        elem = F.struct(k.alias("id"), F.col("season").cast("int").alias("season"), F.col("game_type").alias("gameType"),
                        F.col("game_state").alias("gameState"),
                        F.when(k % 97 != 0, side("home")).alias("homeTeam"), side("away").alias("awayTeam"))
        late = F.struct(k.alias("id"), F.col("season").cast("int").alias("season"), F.lit("LATE").alias("gameType"),
                        F.col("game_state").alias("gameState"),
                        F.when(k % 97 != 0, side("home")).alias("homeTeam"), side("away").alias("awayTeam"))
        base = g.select(F.lit(0).alias("request_seq"), "game_date", "game_id", elem.alias("e"))
        again = g.filter(k % 13 == 0).select(F.lit(1).alias("request_seq"), "game_date", "game_id", late.alias("e"))
        both = base.unionByName(again).withColumn("chunk", F.floor(F.col("game_id") / 65536))
        docs = both.groupBy("request_seq", "game_date", "chunk").agg(
            F.sort_array(F.collect_list(F.struct(F.col("game_id").alias("k"), F.col("e").alias("e")))).alias("a"))
        day = F.to_json(F.struct(F.date_format("game_date", "yyyy-MM-dd").alias("date"),
                                 F.col("a").getField("e").alias("games")))
        raw = F.concat(F.lit('{"gameWeek":['), day, F.lit(',{"games":[]},{"date":null,"games":[1]},7]}'))
        return docs.select("request_seq", F.concat(F.lit("schedule/"), F.col("request_seq").cast("string"), F.lit("/"),
                                                   F.date_format("game_date", "yyyy-MM-dd"), F.lit("-"),
                                                   F.col("chunk").cast("string"), F.lit(".json")).alias("path"),
                           raw.alias("raw"))

    @cached_property
    def boxscore_payloads(self) -> DataFrame:
        """Boxscore documents per game and block of 1024 player ids (a document never holds more than
        1024 entries, however the rows are spread): even player ids on the home side, odd on the away side.

        Games with id % 89 = 0 have no away team id (that side must be skipped).
        """
        s = self.stats.join(self.player.select("player_id", "position_code"), "player_id")
        s = s.join(self.game.select("game_id", "home_team_id", "away_team_id"), "game_id")
        toi = F.when(F.col("time_on_ice_seconds").isNotNull(), F.concat(
            F.floor(F.col("time_on_ice_seconds") / 60).cast("string"), F.lit(":"),
            F.lpad((F.col("time_on_ice_seconds") % 60).cast("string"), 2, "0")))
        stat = F.struct(F.col("player_id").alias("playerId"), "goals", "assists", F.col("shots").alias("sog"), "hits",
                        F.col("blocks").alias("blockedShots"), F.col("penalty_minutes").alias("pim"), toi.alias("toi"))
        # a group's entries are JSON text: one list a document, put in order of group and player by one natural sort
        slot = F.when(F.col("player_id") % 2 == 0, 3).otherwise(0) + F.when(F.col("position_code") == "C", 0).when(
            F.col("position_code") == "D", 1).otherwise(2)
        s = s.select("game_id", "home_team_id", "away_team_id", F.floor(F.col("player_id") / 1024).alias("chunk"),
                     F.struct(slot.alias("slot"), F.col("player_id").alias("k"), F.to_json(stat).alias("e")).alias("entry"))
        g = s.groupBy("game_id", "chunk", "home_team_id", "away_team_id").agg(
            F.sort_array(F.collect_list("entry")).alias("entries"))

        def group(i):
            of_slot = F.filter("entries", lambda x: x["slot"] == i)
            return F.concat(F.lit("["), F.array_join(F.transform(of_slot, lambda x: x["e"]), ","), F.lit("]"))

        g = g.select("*", *[group(i).alias(f"{p}_{code}") for i, (p, code) in enumerate(
            (p, code) for p in "ah" for code in ("C", "D", "G"))])
        k = F.col("game_id")

        def side(p):
            return F.concat(F.lit('{"forwards":'), F.col(f"{p}_C"), F.lit(',"defense":'), F.col(f"{p}_D"),
                            F.lit(',"goalies":'), F.col(f"{p}_G"), F.lit("}"))

        away_id = F.when(k % 89 != 0, F.concat(F.lit('"id":'), F.col("away_team_id").cast("string")))
        raw = F.concat(F.lit('{"awayTeam":{'), F.coalesce(away_id, F.lit("")), F.lit('},"homeTeam":{"id":'),
                       F.col("home_team_id").cast("string"), F.lit('},"playerByGameStats":{"awayTeam":'), side("a"),
                       F.lit(',"homeTeam":'), side("h"), F.lit("}}"))
        return g.select("game_id", F.concat(F.lit("boxscore/"), k.cast("string"), F.lit("/"),
                                            F.col("chunk").cast("string"), F.lit(".json")).alias("path"),
                        raw.alias("raw"))
