"""Fact plans: full load, incremental load, parent rollup.

Daily order lines (order_id, order_placement_date, customer_id, product_id,
order_qty as text) are cleaned, deduplicated on the line key *after* the
ids are cleaned, resolved to a product_code, kept at daily grain per product
id in the child's gold fact and rolled up to (month, product_code,
customer_code) for the parent.  An incremental batch merges into silver,
then gold and the parent's sums are recomputed for the months the batch touched only: a re-run replaces the
same months with the same numbers.

Which value of a line stands is decided by its *sequence* (the load id, then a column of the batch such as the
file name, if one is given), never by the order in which batches arrive: the highest sequence wins, and among lines of
one sequence the largest quantity.  Load ids must therefore sort in the order in which the
loads are valid.  Lines that occur once give the same result however they are split into batches.

Lines that cannot be loaded (a broken row, no quantity, no order id, a date in no known
format, a product id without a product) are rejects with a reason.  Rejects whose product arrives
later are loaded by ``reload_rejects`` and leave the rejects.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.functions import clean as C
from kiln.functions import constants as K
from kiln.functions.clean import month_start
from kiln.operators.dedupe import dedupe, first_window, has_order
from kiln.operators.diff import CHANGE_TYPE
from kiln.operators.lookup import resolve_key
from kiln.operators.materialize import materialize, scratch_scope
from kiln.operators.rollup import affected_periods, monthly_rollup, recompute_periods
from kiln.operators.sizing import bounded_broadcast, estimated_bytes, fits, hashed_fits, load_settings
from kiln.operators.upsert import upsert
from kiln.plans.dims import product_keys
from kiln.sources.csv import CORRUPT
from kiln.sources.tables import LOAD, TableStore, in_periods, new_load_id, rebalanced

ORDER_COLS = ("order_id", "order_placement_date", "customer_id", "product_id", "order_qty")
# several product ids can share a product_code, so the line keys carry the id
SILVER_KEYS = ("order_id", "order_placement_date", "customer_id", "product_id")
GOLD_KEYS = ("order_id", "date", "customer_code", "product_id")
PARENT_KEYS = ("date", "product_code", "customer_code")
REASON, ACCEPTED = "reject_reason", ""
MONTH, SEQ = "month", "load_seq"


def _typed(bronze: DataFrame) -> DataFrame:
    """Typed order lines, every one of them, with ``reject_reason`` (NULL: none).

    A filter on the date would be pushed below the projection and parse every text there once more, in code too large
    to be compiled.  It does not pass the ``explode``, of an array of one.  The text that the formats are tried on is a column of a
    projection below, so that it is made once and the code of the parse stays small enough too.
    """
    typed = bronze.withColumn("order_placement_date", C.date_text("order_placement_date")).withColumns({
        "order_qty": C.to_double("order_qty"),
        "order_id": F.trim(F.col("order_id").cast("string")),
        "order_placement_date": F.explode(F.array(C.parse_date("order_placement_date", strip_prefix=False))),
        "customer_id": C.sanitize_id("customer_id", K.BAD_CUSTOMER_ID),
        "product_id": F.trim(F.col("product_id").cast("string")),
    })
    reason = F.when(F.col(CORRUPT).isNotNull(), "broken_row") if CORRUPT in bronze.columns else F
    return typed.withColumn(REASON, reason.when(F.col("order_qty").isNull(), "no_quantity")
                            .when(F.col("order_id").isNull(), "no_order_id")
                            .when(F.col("order_placement_date").isNull(), "bad_date"))


def orders_clean(bronze: DataFrame) -> DataFrame:
    """Typed order lines that have an order id, a date and a quantity."""
    return _typed(bronze).filter(F.col(REASON).isNull()).drop(REASON, CORRUPT)


def orders_silver(bronze: DataFrame, products: DataFrame,
                  dedupe_keys: Sequence[str] = SILVER_KEYS) -> DataFrame:
    """Clean, drop repeated lines, resolve product_code.

    Repeated lines (same order, date, customer and product id) keep the
    largest quantity, so every line key occurs once.  Unknown product ids
    (placeholders, sentinel) are dropped by the inner join; ``order_rejects``
    returns them.
    """
    df = dedupe(orders_clean(bronze), list(dedupe_keys), [F.col("order_qty").desc()])
    return resolve_key(df, product_keys(products), "product_id", ["product_code"])


def judge_lines(bronze: DataFrame, products: DataFrame) -> DataFrame:
    """Every line typed and resolved in one pass: ``product_code``, ``reject_reason`` (empty: accepted) and the
    line as it came in ``__raw``."""
    return _judge(bronze, bounded_broadcast(product_keys(products)))


def _judge(bronze: DataFrame, keys: DataFrame) -> DataFrame:
    # resolved as they came and typed after: where the ids exceed the broadcast bound, no line moves as text and typed as well
    line = bronze.withColumn("__id", F.trim(F.col("product_id").cast("string")))
    found = resolve_key(line, keys.withColumnRenamed("product_id", "__id"), "__id", ["product_code"], how="left", max_broadcast_bytes=None)
    raw = found.drop("__id").withColumn("__raw", F.struct(*[F.col(f"`{c}`") for c in bronze.columns]))
    judged = _typed(raw)
    unknown = F.when(F.col("product_code").isNull(), "unknown_product")
    rest = [f"`{c}`" for c in judged.columns if c not in ("product_id", "product_code")]
    return (judged.select("product_id", *rest, "product_code")
            .withColumn(REASON, F.coalesce(F.col(REASON), unknown, F.lit(ACCEPTED))))


def order_rejects(bronze: DataFrame, products: DataFrame) -> DataFrame:
    """The landed lines that silver leaves out, as they came, with ``reject_reason``."""
    return judge_lines(bronze, products).filter(F.col(REASON) != ACCEPTED).select("__raw.*", REASON)


def orders_gold(silver: DataFrame) -> DataFrame:
    """Daily-grain child fact with the parent's column names."""
    return silver.select("order_id", F.col("order_placement_date").alias("date"),
                         "product_code", F.col("customer_id").alias("customer_code"),
                         "product_id", F.col("order_qty").alias("sold_quantity"))


def parent_rollup(gold: DataFrame) -> DataFrame:
    """Monthly parent fact: sum per (month, product_code, customer_code) as bigint (F1, K5)."""
    return monthly_rollup(gold, "date", ["product_code", "customer_code"], "sold_quantity")


@dataclass
class FactState:
    silver: DataFrame
    gold: DataFrame
    parent: DataFrame


def full_load(bronze: DataFrame, products: DataFrame,
              parent: DataFrame | None = None) -> FactState:
    """All landing files at once."""
    silver = orders_silver(bronze, products)
    gold = orders_gold(silver)
    monthly = parent_rollup(gold)
    new_parent = monthly if parent is None else upsert(parent, monthly, PARENT_KEYS)
    return FactState(silver, gold, new_parent)


def incremental_load(batch: DataFrame, products: DataFrame, state: FactState) -> FactState:
    """One new batch on top of an existing state.

    The batch DataFrame itself plays the staging table.  Affected months are
    those of the batch's cleaned lines; their sums are recomputed from the
    whole daily fact and replace the parent's rows for those months.
    """
    batch_silver = orders_silver(batch, products)
    silver = upsert(state.silver, batch_silver, SILVER_KEYS)
    batch_gold = orders_gold(batch_silver)
    gold = upsert(state.gold, batch_gold, GOLD_KEYS)
    months = affected_periods(batch_gold, "date")
    sums = recompute_periods(gold, "date", months, ["product_code", "customer_code"],
                             "sold_quantity")
    return FactState(silver, gold, upsert(state.parent, sums, PARENT_KEYS))


# --- runner with table writes -------------------------------------------------
#: bytes of stored lines for a task of the merge; its two sorts hold 45 to 80 times as many in memory, more in larger tables,
#: which are better compressed
LINE_TASK_BYTES = 3 << 20
#: bytes of a scan's split in a load; a write by month sorts them, 10 to 40 times as many in memory
SPLIT_BYTES = 16 << 20
#: months that a task writes without sorting its rows by month; tasks hold ranges of months
OPEN_MONTHS = 8
_LINE, _GROUP = "__line", "__group"
_SPREAD, _NEW, _DEAD, _HELD, _SUM, _OLD, _SAME = "__spread", "__new", "__dead", "__held", "__sum", "__old", "__same"
_CODE, _CODE_ID, _REF = "__code", "__code_id", "__ref"


def _accepted(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col(REASON) == ACCEPTED).drop("__raw", REASON, CORRUPT)


def _line_batch(judged: DataFrame) -> DataFrame:
    """One row per line key of the accepted lines: the highest sequence, then the largest quantity."""
    latest = dedupe(_accepted(judged), list(SILVER_KEYS), [F.col(SEQ).desc(), F.col("order_qty").desc()])
    return latest.withColumn(MONTH, month_start("order_placement_date"))


def _touched(judged: DataFrame) -> DataFrame:
    """The months of the accepted lines, a few rows that never leave the executors."""
    return (judged.filter(F.col(REASON) == ACCEPTED)
            .select(month_start("order_placement_date").alias(MONTH)).distinct())


def _both_columns(a: DataFrame, b: DataFrame) -> DataFrame:
    """``a`` with the columns that only ``b`` has as NULL."""
    return a.withColumns({f.name: F.lit(None).cast(f.dataType) for f in b.schema.fields if f.name not in a.columns})


class _Codes:
    """Product codes kept out of shuffles and stages.

    A code is a long text that does not compress, and a function of the product id.  Where the list of codes is within the
    broadcast bound, a *reference* stands for it: the smallest product id of the code, or the text itself of a code of no product
    (``encode``, ``decode``).  Where ``(product_id, product_code)`` is within the bound too, a line moves without even
    that unless its stored code is another than today's (``strip``, ``refs``).  Beyond the bounds codes move as they are.
    """

    def __init__(self, products: DataFrame):
        self.table = materialize(product_keys(products), "product-codes")
        ids = self.table.groupBy("product_code").agg(F.min("product_id").alias(_CODE_ID))
        self._ids = materialize(ids, "code-ids")
        self._short = fits(self._ids) and hashed_fits(self._ids)
        # what lines are resolved against: the reference is what they keep, so no line meets a code
        refs = materialize(self.encode(self.table), "product-refs") if self._short else self.table
        self.late = self._short and fits(self.table) and hashed_fits(refs)
        self.keys = F.broadcast(refs) if self.late else refs
        self._by_id = F.broadcast(refs.withColumnRenamed("product_code", _REF))

    def strip(self, lines: DataFrame) -> DataFrame:
        """Lines with references as they move: none if it is today's."""
        if not self.late:
            return lines
        known = lines.join(self._by_id, "product_id", "left")
        other = F.when(~F.col("product_code").eqNullSafe(F.col(_REF)), F.col("product_code"))
        return known.withColumn("product_code", other).select(*lines.columns)

    def refs(self, lines: DataFrame) -> DataFrame:
        """Lines that have moved, all with their reference."""
        if not self.late:
            return lines
        known = lines.join(self._by_id, "product_id", "left")
        return known.withColumn("product_code", F.coalesce("product_code", _REF)).select(*lines.columns)

    def restore(self, lines: DataFrame) -> DataFrame:
        return self.decode(self.refs(lines))

    def encode(self, rows: DataFrame) -> DataFrame:
        if not self._short:
            return rows
        known = rows.join(F.broadcast(self._ids), "product_code", "left")
        short = F.coalesce(F.concat(F.lit("#"), _CODE_ID), F.concat(F.lit("="), "product_code"))
        return known.withColumn("product_code", short).select(*rows.columns)

    def decode(self, rows: DataFrame) -> DataFrame:
        if not self._short:
            return rows
        ids = self._ids.select(F.concat(F.lit("#"), _CODE_ID).alias(_CODE_ID), F.col("product_code").alias(_CODE))
        known = rows.join(F.broadcast(ids), F.col("product_code") == F.col(_CODE_ID), "left")
        return known.withColumn("product_code", F.coalesce(_CODE, F.substr("product_code", F.lit(2)))).select(*rows.columns)


@dataclass
class _Names:
    """The tables of one kind of line."""

    name: str
    parent: str

    @property
    def daily(self) -> str:
        return f"fact_{self.name}_daily"

    @property
    def rejects(self) -> str:
        return f"rejects_{self.name}"

    @property
    def changes(self) -> str:
        return f"changes_{self.name}"


def _judged(lines: DataFrame, codes: _Codes, seq: Column, name: str) -> DataFrame:
    """A stored copy of the judged lines; only rejects keep the line as it came, and no accepted line its code if
    that is found again later."""
    judged = _judge(lines, codes.keys).withColumn(SEQ, seq)
    judged = judged.withColumn("__raw", F.when(F.col(REASON) != ACCEPTED, F.col("__raw")))
    if codes.late:
        judged = judged.withColumn("product_code", F.lit(None).cast("string"))
    return materialize(judged, f"judged-{name}")


def land_lines(store: TableStore, bronze: DataFrame, products: DataFrame, name: str = "orders",
               load_id: str | None = None, sequence: Column | None = None) -> None:
    """Write a landing batch to bronze and its rejects beside it, each as the partition ``load_id``.

    The landing files are scanned once and lines are typed once.  Taking the
    same load again replaces its partitions.  ``sequence`` is an expression over the batch's columns.
    """
    _landed(store, bronze, _Codes(products), name, load_id or new_load_id(), sequence)


def _landed(store: TableStore, bronze: DataFrame, codes: _Codes, name: str, load_id: str,
            sequence: Column | None) -> DataFrame:
    """Land a batch; returns the judged lines, which feed everything else."""
    landed = store.write_load(bronze, "bronze", name, load_id)
    seq = F.lit(load_id) if sequence is None else F.concat_ws("/", F.lit(load_id), sequence.cast("string"))
    judged = _judged(landed, codes, seq, name)
    store.write_load(judged.filter(F.col(REASON) != ACCEPTED).select("__raw.*", REASON),
                     "silver", _Names(name, "").rejects, load_id)
    return judged


def _latest_lines(lines: DataFrame, current: DataFrame | None, stored_bytes: int, dead: Column | None = None,
                  held: DataFrame | None = None) -> DataFrame:
    """One row per line key of new ``lines`` and ``current`` ones: the highest sequence (a stored NULL is lowest), among equal
    ones the new, then the largest quantity.  ``__new`` tells where the row is from.

    A new row that stands tells in ``__same`` whether it is in all columns as the current one of its key, and holds that
    one's values in ``__old`` if it differs.

    Current lines that are ``dead`` give way to all others and stay beside them, marked ``__dead``; rows of the parent that are
    ``held`` (``_held_rows``) come along, with a NULL in ``__new``.

    Rows move once, by ranges of (month, hash of the customer): ranges cut a large month
    and join small ones, so a task writes few files of few months, and its rows are bounded by ``LINE_TASK_BYTES`` (but for
    a customer with more lines in a month).  Lines of one key and lines of one sum of the parent lie in one task.
    """
    rows, kept, alive = lines.withColumn(_NEW, F.lit(True)), [], F.lit(True)
    if dead is not None:
        rows, alive = rows.withColumn(_DEAD, F.lit(False)), ~F.col(_DEAD)
    if current is not None:
        types = {f.name: f.dataType for f in current.schema.fields}
        rows = rows.withColumns({c: F.col(f"`{c}`").cast(types[c]) for c in lines.columns if c in types})
        kept = [c for c in current.columns if c not in (*lines.columns, MONTH)]  # a match leaves them as they are
        stored = current.drop(MONTH).withColumn(_NEW, F.lit(False))
        rows = rows.unionByName(stored if dead is None else stored.withColumn(_DEAD, dead), allowMissingColumns=True)
    if held is not None:
        rows = rows.unionByName(held, allowMissingColumns=True)
    tasks = -(-stored_bytes // LINE_TASK_BYTES)
    by = {MONTH: month_start("order_placement_date"), _SPREAD: F.hash("customer_id")}
    rows = rows.repartitionByRange(max(1, tasks), *by.values()).withColumns(by)  # made again, so that they do not move
    # a hash of the key comes first, as a sort compares its first column as a number; a month, or texts, are compared row by row
    rows = rows.withColumn(_LINE, F.xxhash64(*SILVER_KEYS))
    keys = [_LINE, MONTH, _SPREAD, *SILVER_KEYS]
    one = Window.partitionBy(*keys)
    rows = rows.withColumns({c: F.when(F.col(_NEW) & alive, F.first(F.when(alive, F.col(c)), ignorenulls=True).over(one))
                             .otherwise(F.col(c)) for c in kept}) if kept else rows
    order = [F.col(SEQ).desc_nulls_last(), F.col(_NEW).desc(), F.col("order_qty").desc()]
    besides = F.lit(False) if held is None else F.col(_NEW).isNull()
    if dead is not None:
        order, besides = [F.col(_DEAD), *order], besides | F.col(_DEAD)
    # the window of the order finds the current row too, so its rows are sorted once
    ordered = first_window(rows, keys, order)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    values = F.struct(*[F.col(f"`{c}`") for c in ([] if current is None else current.columns) if c not in (*SILVER_KEYS, MONTH)] or [SEQ])
    old = F.when(~F.col(_NEW), values)
    old = F.first(old, ignorenulls=True).over(whole) if current is not None else F.when(F.lit(False), values)
    rows = rows.withColumns({_OLD: old, "__place": F.row_number().over(ordered)})
    equal = F.col(_OLD).eqNullSafe(values) if has_order(rows.select(values).schema[0].dataType) else F.lit(False)  # maps compare with nothing
    same = F.col(_NEW) & F.col(_OLD).isNotNull() & equal
    return (rows.filter((F.col("__place") == 1) | besides).drop("__place", _LINE)
            .withColumn(_SAME, same).withColumn(_OLD, F.when(F.col(_NEW) & ~F.col(_SAME), F.col(_OLD))))


def _held_rows(parent: DataFrame, codes: _Codes) -> DataFrame:
    """Rows of the parent in the columns of lines, to move with them; what is no key goes along in ``__held``."""
    rest = [F.col(f"`{c}`") for c in parent.columns if c not in PARENT_KEYS]
    date, code, customer = PARENT_KEYS
    return codes.encode(parent.withColumn(code, F.col(code).cast("string"))).select(
        F.col(date).cast("date").alias("order_placement_date"), F.col(customer).cast("string").alias("customer_id"),
        "product_code", F.lit(None).cast("boolean").alias(_NEW), F.struct(*rest).alias(_HELD))


def _with_sums(rows: DataFrame, replaced: bool) -> DataFrame:
    """Lines and held rows of a merge with the parent's new sums in ``__sum``: in the first line of a sum that the parent has no
    row of, and in the held rows that it replaces.  Dead lines go, and with ``replaced`` held rows that only they account for.

    A sum's lines lie in one task and its groups are found by a sort, so nothing moves.
    """
    alive = ~F.col(_DEAD) if replaced else F.lit(True)
    line, held = F.col(_NEW).isNotNull() & alive, F.col(_NEW).isNull()
    rows = rows.withColumn(_GROUP, F.xxhash64(MONTH, "customer_id", "product_code"))  # first, as in _latest_lines
    ordered = (Window.partitionBy(_GROUP, MONTH, _SPREAD, "customer_id", "product_code")
               .orderBy(F.when(line, 0).otherwise(1), "order_id", "order_placement_date", "product_id"))
    group = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # of one sort and one window
    some = lambda which: F.count(F.when(which, True)).over(group) > 0
    match = F.col("customer_id").isNotNull() & F.col("product_code").isNotNull()  # as in a MERGE, a NULL key matches nothing
    first = F.row_number().over(ordered) == 1
    rows = rows.withColumns({"__first": first, "__lines": some(line), "__helds": some(held), "__was": some(~F.col(_NEW)),
                             _SUM: F.sum(F.when(line, F.col("order_qty"))).over(group).cast("bigint")})
    rows = rows.withColumn(_SUM, F.when(F.when(held, match & F.col("__lines"))
                                        .otherwise(F.col("__first") & ~(match & F.col("__helds"))), F.col(_SUM)))
    if replaced:
        gone = held & match & F.col("__was") & ~F.col("__lines")
        rows = rows.filter((held | alive) & ~gone).drop(_DEAD)
    return rows.drop("__first", "__lines", "__helds", "__was", _SPREAD, _GROUP)


def _parent_rows(staged: DataFrame, parent: DataFrame) -> DataFrame:
    """The rows of the touched months in the columns of ``parent``."""
    date, code, customer = PARENT_KEYS
    here = {date: F.col(MONTH), code: F.col(code), customer: F.col("customer_id")}

    def value(f) -> Column:
        if f.name in here:
            return here[f.name].cast(f.dataType)
        was = F.col(_HELD)[f.name] if _HELD in staged.columns else F.lit(None)
        return (F.coalesce(F.col(_SUM).cast(f.dataType), was) if f.name == "sold_quantity" else was).cast(f.dataType)

    return (staged.filter(F.col(_SUM).isNotNull() | F.col(_NEW).isNull())
            .select(*[value(f).alias(f.name) for f in parent.schema.fields]))


def _line_changes(staged: DataFrame, codes: _Codes, columns: Sequence[str]) -> DataFrame:
    """What the new lines of a merge changed, in ``columns``: inserted lines, and lines before and after."""
    old = {c: F.col(_OLD)[c] if c in staged.schema[_OLD].dataType.names else F.col(f"`{c}`") for c in columns}
    old["product_code"] = F.coalesce(old["product_code"], F.col("product_code"))  # none: today's, as the new line's

    def image(kind: str, value) -> Column:
        return F.struct(*[value(c).alias(c) for c in columns], F.lit(kind).alias(CHANGE_TYPE))

    now = lambda c: F.col(f"`{c}`")
    differs = F.lit(False)
    for c in old:
        differs = differs | ~now(c).eqNullSafe(old[c]) if c not in SILVER_KEYS else differs
    changes = (F.when(F.col(_OLD).isNull(), F.array(image("insert", now)))
               .when(differs, F.array(image("update_preimage", old.get), image("update_postimage", now))))
    return codes.decode(staged.filter(F.col(_NEW) & ~F.col(_SAME)).select(F.explode(changes).alias("__change")).select("__change.*"))


def _changed_months(staged: DataFrame) -> DataFrame:
    """The months in which a merge changed a line or a row of the parent."""
    sum_is_new = F.col(_SUM).isNotNull()
    if _HELD in staged.columns:
        held = F.col(_HELD)["sold_quantity"]
        sum_is_new &= F.col(_NEW).isNotNull() | ~F.col(_SUM).cast(staged.schema[_HELD].dataType["sold_quantity"].dataType).eqNullSafe(held)
    changed = F.coalesce(F.col(_NEW) & ~F.col(_SAME), F.lit(False)) | sum_is_new
    return staged.filter(changed).select(MONTH).distinct()


def _merge_lines(store: TableStore, judged: DataFrame, codes: _Codes, names: _Names, load_id: str, replace_periods: bool,
                 change_feed: bool) -> None:
    """Merge judged lines into silver, gold and parent.

    The batch, silver's lines of its months and the parent's rows of them move once and are staged with the new sums; the three
    tables are projections of that, written side by side.
    """
    name, daily, parent = names.name, names.daily, names.parent
    lines, months = _accepted(judged), _touched(judged)
    schema = lines.withColumn(MONTH, month_start("order_placement_date")).schema
    first = not store.exists("silver", name)
    if first and store.exists("gold", daily):
        raise ValueError(f"the daily fact {daily} has no silver table {name} that it could be made from")
    size = estimated_bytes(judged)
    current, moved, older, added = None, None, F.lit(True), False
    if not first:
        stored = store.read("silver", name, schema)
        added = not set(lines.columns) <= set(stored.columns)
        # partition pruning by the join: exact, because the month is a function of the line key
        current = codes.encode(_both_columns(in_periods(stored, MONTH, months), lines))
        older = F.coalesce(F.substring_index(SEQ, "/", 1), F.lit("")) <= load_id
        moved, size = codes.strip(current), size + estimated_bytes(stored)
    sums = parent_rollup(orders_gold(lines)).limit(0)  # for the columns of a parent that is not there yet
    held = None
    if store.exists("gold", parent):
        sums = store.read("gold", parent, sums.schema)
        held = _held_rows(in_periods(sums, "date", months.withColumnRenamed(MONTH, "date")), codes)
        size += estimated_bytes(sums)
    replaced = replace_periods and not first
    merged = _latest_lines(lines, moved, size, older if replaced else None, held)
    # in the order of the lines, where neighbours share order, date and customer: files about a third smaller; the writer parts months.
    # Held rows, which have no order, follow by customer: a sort compares all columns of rows whose first is equal
    by_order = F.coalesce("order_id", F.concat(F.lit("~"), "customer_id"))
    summed = _with_sums(codes.refs(merged), replaced).withColumn(_LINE, by_order).sortWithinPartitions(_LINE, *SILVER_KEYS).drop(_LINE)
    staged = store.stage(summed, name, load_id, "silver", name, [MONTH])
    if change_feed and not store.has_load("silver", names.changes, load_id):
        # a load taken again changes nothing: its feed stays that of the first time
        columns = [c for c in (staged.drop(_NEW, _SUM, _HELD, _OLD, _SAME) if first else current).columns if c not in (SEQ, MONTH)]
        changes = _line_changes(staged, codes, columns)
        if replaced:
            batch = staged.filter(_NEW).select(*SILVER_KEYS)
            left = codes.decode(current.filter(older).join(batch, list(SILVER_KEYS), "left_anti")).drop(SEQ, MONTH)
            changes = changes.unionByName(left.withColumn(CHANGE_TYPE, F.lit("delete")))
        store.write_load(changes, "silver", names.changes, load_id)

    if not first and not replaced and store.exists("gold", daily) and not added:
        # a month that is as it was, in a load taken again, is not written again
        staged = in_periods(staged, MONTH, materialize(_changed_months(staged), "changed-months"))
    # the months are complete, so gold is a projection of silver and the sums are final
    silver = codes.decode(staged.filter(F.col(_NEW).isNotNull()).drop(_NEW, _SUM, _HELD, _OLD, _SAME))
    gold = orders_gold(silver).withColumn(MONTH, month_start("date"))
    tables = [(silver, "silver", name, MONTH), (gold, "gold", daily, MONTH), (_parent_rows(codes.decode(staged), sums), "gold", parent, "date")]
    if first:
        # a first load that dies leaves no gold without silver, and can be run again
        silver, layer, table, by = tables.pop(0)
        store.publish(silver, layer, table, [by])
    with ThreadPoolExecutor(len(tables)) as pool:
        for done in [pool.submit(store.publish, df, layer, table, [by]) for df, layer, table, by in tables]:
            done.result()


class LoadedState:
    """The tables after a load; each is read when it is asked for."""

    def __init__(self, store: TableStore, judged: DataFrame, names: _Names):
        batch = _line_batch(judged)
        gold = orders_gold(batch)
        self._store = store
        self._tables = {"silver": ("silver", names.name, batch.schema), "parent": ("gold", names.parent, parent_rollup(gold).schema),
                        "gold": ("gold", names.daily, gold.withColumn(MONTH, month_start("date")).schema)}

    def __getattr__(self, table: str) -> DataFrame:
        if table not in ("silver", "gold", "parent"):
            raise AttributeError(table)
        return self._store.read(*self._tables[table])


def run_fact_load(store: TableStore, bronze: DataFrame, products: DataFrame,
                  name: str = "orders", parent: str = "fact_orders", load_id: str | None = None,
                  sequence: Column | None = None, replace_periods: bool = False,
                  change_feed: bool = False) -> LoadedState:
    """Load one landing batch: a full load when the child tables are absent,
    otherwise incremental — the same steps either way.

    * ``land_lines`` writes the batch as partition ``load_id`` of bronze, and its rejects; columns the
      batch adds stay in bronze and silver;
    * silver and the daily gold fact are partitioned by month; the batch is
      merged into the months it touches only, by sequence (see above);
    * the parent's sums for those months are recomputed from the whole daily
      fact (replacing, never adding) and upserted into the parent's month
      partitions; a parent key absent from the recomputation is kept.

    With ``replace_periods`` the batch restates its months: lines of those months that it does not hold
    are deleted (but for lines of a later load), and the parent loses the child's keys that have vanished; rows
    of others in the parent stay.  ``change_feed`` writes what the merge changed in silver to
    ``silver.changes_<name>``.

    Load ids sort in the order of validity; a random batch gets one that is later than all before.
    A load that died is run again with the same id.
    """
    load_id, names = load_id or new_load_id(), _Names(name, parent)
    store.begin(name, load_id)
    with scratch_scope(store.spark), load_settings(store.spark, SPLIT_BYTES, OPEN_MONTHS):
        codes = _Codes(products)
        judged = _landed(store, bronze, codes, name, load_id, sequence)
        _merge_lines(store, judged, codes, names, load_id, replace_periods, change_feed)
        store.end(name, load_id)
        return LoadedState(store, judged, names)


def reload_rejects(store: TableStore, products: DataFrame, name: str = "orders", parent: str = "fact_orders",
                   load_id: str | None = None) -> LoadedState:
    """Load the rejected lines whose product has arrived since, in the place of their own loads.

    The lines keep the sequence of the load they came with, so they do not overwrite later values.
    They leave the rejects after the facts hold them: a run that dies in between finds
    them again, and loading them twice changes nothing.
    """
    load_id, names = load_id or new_load_id(), _Names(name, parent)
    store.begin(name, load_id)
    with scratch_scope(store.spark), load_settings(store.spark, SPLIT_BYTES, OPEN_MONTHS):
        held = store.read("silver", names.rejects)
        known = product_keys(products).select("product_id").distinct()
        here = F.trim(F.col("product_id").cast("string"))
        found = held.filter(F.col(REASON) == "unknown_product").join(
            known.withColumnRenamed("product_id", "__known"), here == F.col("__known"), "left_semi")
        codes = _Codes(products)
        judged = _judged(found.drop(REASON), codes, F.col(LOAD), name).drop(LOAD)
        if not judged.isEmpty():
            _merge_lines(store, judged, codes, names, load_id, replace_periods=False, change_feed=False)
            gone = F.when(F.col(REASON) == "unknown_product", here)  # NULL: matches no product
            loads = materialize(found.select(LOAD).distinct(), "reloaded")  # one row per load
            touched = held.join(F.broadcast(loads), LOAD, "left_semi")
            left = touched.join(known.withColumnRenamed("product_id", "__known"), gone == F.col("__known"), "left_anti")
            left = store.stage(left, name, load_id, "silver", names.rejects)
            emptied = loads.join(left.select(LOAD).distinct(), LOAD, "left_anti").collect()
            store.publish(rebalanced(left, [LOAD]), "silver", names.rejects, [LOAD])
            for row in emptied:
                store.drop_load("silver", names.rejects, row[LOAD])
        store.end(name, load_id)
        return LoadedState(store, judged, names)
