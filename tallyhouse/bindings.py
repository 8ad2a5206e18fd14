"""The analytic roles played by the general test tables.

Each method gives one table in the declared shape, as a lazy projection of the Parquet
files in one folder. Columns that a plan does not use are never read.

    player       customer       (registered with the first order)
    play         order line     (player of the order, game = part, time = ship date)
                 or event       (player = user, game = event type)
    game         part, or event type
    location     nation in its region
    table        part x supplier, at the supplier's nation
    staff        supplier; a shift lasts as many hours as the line has pieces
    machine      supplier
    transaction  event
    login        event, with a device text from type and props
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import scalars as S
from tallyhouse.operators import dimensions, scd2, windows

AS_OF = "2024-02-01"
# A table code holds part and supplier: code = part * TABLE_STEP + supplier.
TABLE_STEP = 1 << 31


class Roles:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    # -- people

    def player_basic(self) -> DataFrame:
        """Players without the registration date, which costs a pass over the orders."""
        return self.raw("customer").select(
            F.col("c_custkey").alias("email"),
            F.col("c_mktsegment").alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") * 37 % 20000).cast("int")).alias("dob"),
            F.floor("c_acctbal").cast("int").alias("loyalty_points"),
        )

    def player(self) -> DataFrame:
        first = self.raw("orders").groupBy(F.col("o_custkey").alias("email")).agg(F.min("o_orderdate").alias("registration_date"))
        return self.player_basic().join(first, "email", "left")

    def dim_player(self, tiers=None, as_of: str = AS_OF) -> DataFrame:
        """Version 1 of every player, with id."""
        at = F.lit(as_of).cast("date")
        src = self.player_basic().withColumn("registration_date", F.lit(None).cast("timestamp_ntz"))
        rows = dimensions.player_rows(src, at, **({"tiers": tiers} if tiers else {}))
        return scd2.with_id(scd2.init(rows, F.lit(as_of).cast("timestamp_ntz")), "player_key", "player_id")

    def staff(self) -> DataFrame:
        position = F.element_at(F.array(*[F.lit(p) for p in ("Floor Manager", "Dealer", "Security", "Cashier", "Technician")]), (F.col("s_suppkey") % 5 + 1).cast("int"))
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("staff_email"),
            F.col("s_name").alias("first_name"),
            F.col("s_nationkey").cast("string").alias("last_name"),
            position.alias("position"),
            F.date_add(F.lit("2010-01-01").cast("date"), (F.col("s_suppkey") % 3650).cast("int")).alias("hire_date"),
            S.money("s_acctbal").alias("salary"),
        )

    def dim_staff(self) -> DataFrame:
        return scd2.init(dimensions.staff_rows(self.staff()), F.lit(AS_OF).cast("timestamp_ntz"))

    # -- plays

    def _line_money(self) -> list[Column]:
        price, discount = S.money("l_extendedprice"), F.col("l_discount").cast("decimal(4,2)")
        return [price.alias("amount_bet"), (price * (F.lit(1).cast("decimal(3,2)") - discount)).cast(S.MONEY).alias("amount_won")]

    def line_plays(self) -> DataFrame:
        """Plays without a player, for reports by game or time alone."""
        return self.raw("lineitem").select(F.col("l_partkey").alias("game_name"), F.col("l_shipdate").alias("play_time"), *self._line_money())

    def plays(self) -> DataFrame:
        orders = self.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("player_email"))
        lines = self.raw("lineitem").select("l_orderkey", F.col("l_partkey").alias("game_name"), F.col("l_shipdate").alias("play_time"), *self._line_money())
        return lines.join(orders, "l_orderkey").drop("l_orderkey")

    def event_plays(self) -> DataFrame:
        bet = S.money("value")
        won = F.when(F.col("event_type") == "purchase", bet * 2).when(F.col("event_type") == "view", bet).otherwise(F.lit(0))
        return self.raw("events").select(
            F.col("user_id").alias("player_email"), F.col("event_type").alias("game_name"), F.col("ts").alias("play_time"), bet.alias("amount_bet"), won.cast(S.MONEY).alias("amount_won")
        )

    def _as_fact(self, plays: DataFrame) -> DataFrame:
        return plays.select(
            F.to_date("play_time").alias("full_date"),
            "play_time",
            F.col("player_email").alias("player_key"),
            S.surrogate("player_email", F.lit(1)).alias("player_id"),
            "game_name",
            F.col("amount_bet").alias("bet_amount"),
            F.col("amount_won").alias("win_amount"),
            (F.coalesce("amount_won", F.lit(0)) - F.coalesce("amount_bet", F.lit(0))).cast(S.MONEY).alias("net_result"),
            *[c for c in ("location_code", "session_duration_minutes", "staff_key") if c in plays.columns],
        )

    def event_fact(self, session: bool = True) -> DataFrame:
        """Star fact of the events; minutes since the player's previous event on demand."""
        plays = self.event_plays()
        if session:
            plays = windows.minutes_since_previous(plays, ["player_email"], "play_time", ["game_name", "amount_bet"])
        return self._as_fact(plays)

    def line_fact(self) -> DataFrame:
        """Star fact of the order lines, at the place and with the staff of the line's supplier."""
        orders = self.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("player_email"))
        places = self.raw("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("location_code"))
        lines = self.raw("lineitem").select("l_orderkey", "l_suppkey", F.col("l_partkey").alias("game_name"), F.col("l_shipdate").alias("play_time"), *self._line_money())
        rows = lines.join(orders, "l_orderkey").join(places, "l_suppkey")
        return self._as_fact(rows.withColumnRenamed("l_suppkey", "staff_key"))

    def line_fact_short(self) -> DataFrame:
        """As `line_fact` without the player, so without the orders."""
        places = self.raw("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("location_code"))
        lines = self.line_plays_with_staff().join(places, "l_suppkey")
        return self._as_fact(lines.withColumnRenamed("l_suppkey", "staff_key").withColumn("player_email", F.lit(None).cast("long")))

    def line_plays_with_staff(self) -> DataFrame:
        return self.raw("lineitem").select("l_suppkey", F.col("l_partkey").alias("game_name"), F.col("l_shipdate").alias("play_time"), *self._line_money())

    def order_fact(self) -> DataFrame:
        """Star fact of whole orders: no game."""
        amount = S.money("o_totalprice")
        return self.raw("orders").select(
            F.to_date("o_orderdate").alias("full_date"), F.col("o_orderdate").alias("play_time"), F.col("o_custkey").alias("player_key"), amount.alias("bet_amount"), F.lit(0).cast(S.MONEY).alias("win_amount")
        )

    # -- games and places

    def game(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("game_name"), F.col("p_type").alias("type"), F.col("p_size").cast("decimal(10,2)").alias("min_bet"), F.col("p_retailprice").cast("decimal(10,2)").alias("max_bet")
        )

    def dim_game(self) -> DataFrame:
        return dimensions.game_dim(self.game())

    def event_game(self) -> DataFrame:
        return self.raw("events").groupBy(F.col("event_type").alias("game_name")).agg(
            F.first("event_type").alias("type"), F.min(F.col("value").cast("decimal(10,2)")).alias("min_bet"), F.max(F.col("value").cast("decimal(10,2)")).alias("max_bet")
        )

    def location(self) -> DataFrame:
        region = self.raw("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
        return self.raw("nation").join(region, "n_regionkey").select(
            F.col("n_nationkey").alias("location_code"),
            F.concat(F.lit("House "), "n_name").alias("name"),
            F.lit(None).cast("string").alias("address"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.col("r_name").alias("country"),
        )

    def dim_location(self) -> DataFrame:
        return dimensions.location_dim(self.location())

    def _table_code(self) -> Column:
        return (F.col("l_partkey") * F.lit(TABLE_STEP) + F.col("l_suppkey")).alias("table_code")

    def table_game(self) -> DataFrame:
        pairs = self.raw("lineitem").select("l_partkey", "l_suppkey").distinct()
        places = self.raw("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("location_code"))
        status = F.element_at(F.array(F.lit("Available"), F.lit("In Use"), F.lit("Maintenance")), (F.col("l_partkey") % 3 + 1).cast("int"))
        return pairs.join(places, "l_suppkey").select(self._table_code(), F.col("l_partkey").alias("game_name"), "location_code", status.alias("status"))

    def shifts(self) -> DataFrame:
        """One shift per line; its length in hours is the quantity."""
        end = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_quantity").cast("int"))
        return self.raw("lineitem").select(F.col("l_suppkey").alias("staff_email"), self._table_code(), F.col("l_shipdate").alias("shift_start"), end.alias("shift_end"))

    def event_tables(self) -> DataFrame:
        """One table per event type and nation of a user, at that nation."""
        users = self.raw("customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("location_code"))
        pairs = self.raw("events").select("user_id", F.col("event_type").alias("game_name")).distinct().join(users, "user_id").select("game_name", "location_code").distinct()
        code = F.concat_ws("-", "game_name", F.format_string("%03d", "location_code"))
        return pairs.select(code.alias("table_code"), "game_name", "location_code", F.lit("Available").alias("status"))

    def event_shifts(self) -> DataFrame:
        """Suppliers work at the tables of their nation."""
        staff = self.raw("supplier").select(F.col("s_suppkey").alias("staff_email"), F.col("s_nationkey").alias("location_code"))
        return self.event_tables().join(staff, "location_code").select("table_code", "staff_email")

    def slot_machine(self) -> DataFrame:
        status = F.element_at(F.array(F.lit("Online"), F.lit("Offline"), F.lit("Maintenance")), (F.col("s_suppkey") % 3 + 1).cast("int"))
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("machine_code"), F.col("s_nationkey").alias("location_code"), status.alias("status"), F.concat(F.lit("M"), (F.col("s_suppkey") % 7).cast("string")).alias("model")
        )

    def slot_play(self) -> DataFrame:
        orders = self.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("player_email"))
        bet, won = self._line_money()
        lines = self.raw("lineitem").select("l_orderkey", F.col("l_suppkey").alias("machine_code"), F.col("l_shipdate").alias("play_time"), bet.alias("bet_amount"), won.alias("win_amount"))
        return lines.join(orders, "l_orderkey").drop("l_orderkey")

    # -- money, logins, rewards, results, audit

    def _k(self) -> Column:
        return F.get_json_object("props", "$.k").cast("long")

    def transaction(self) -> DataFrame:
        kind = (
            F.when(F.col("event_type") == "purchase", "Bet")
            .when(F.col("event_type") == "view", "Win")
            .when(F.col("event_type") == "click", "Deposit")
            .when(F.col("event_type") == "signup", "Withdraw")
            .otherwise("Other")
        )
        return self.raw("events").select(
            F.col("event_id").alias("transaction_code"),
            F.col("user_id").alias("player_email"),
            S.money("value").alias("amount"),
            kind.alias("transaction_type"),
            F.col("ts").alias("transaction_time"),
            self._k().alias("game_name"),
        )

    def login_history(self) -> DataFrame:
        kind = F.when(F.col("event_type") == "view", "Android Mobile").when(F.col("event_type") == "click", "iPad tablet").when(F.col("event_type") == "error", "Mobile Tablet").otherwise("Laptop")
        return self.raw("events").select(
            F.col("event_id").alias("login_id"),
            F.col("user_id").alias("player_email"),
            F.col("ts").alias("login_time"),
            F.concat(kind, F.lit(" "), self._k().cast("string")).alias("device"),
        )

    def reward(self) -> DataFrame:
        return self.raw("part").select(F.col("p_partkey").alias("reward_code"), F.col("p_name").alias("name"), F.col("p_size").alias("points_required"))

    def player_reward(self) -> DataFrame:
        return self.plays().select("player_email", F.col("game_name").alias("reward_code"), F.col("play_time").alias("redeem_date"))

    def game_result(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_partkey").alias("game_name"), self._table_code(), F.col("l_shipdate").alias("result_time"), F.col("l_returnflag").alias("outcome_description")
        )

    def audit_log(self) -> DataFrame:
        return self.raw("events").select(F.col("event_id").alias("log_code"), "event_type", F.col("ts").alias("event_time"), F.col("user_id").alias("performed_by"), F.col("props").alias("details"))
