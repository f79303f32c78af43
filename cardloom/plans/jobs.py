"""The import workloads end to end: landed files in, current tables and histories out.

Tables are held in a ``Store``: current tables are buckets by key, of which an import
rewrites those it touches; histories are appended under the id of their day or file, so an
import that is repeated adds nothing twice.  All tables of an import change in one commit,
with its row of the ledger.  Without a store they are scratch tables.  What a job can't
take goes into ``Catalogue.quarantine`` with its reason, and is counted.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext
from dataclasses import dataclass, field, replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.operators import cards, cascades, constraints, decks, latest, ledger, links, market, merge, tags
from cardloom.sources import files, json_files, schemas, storage
from cardloom.sources.storage import written

CARD_COLUMNS = ("name", "normalized_name", "mana_cost", "mana_value", "type_line", "oracle_text", "power", "toughness", "loyalty", "defense", "colors", "color_identity", "keywords", "legal_commander", "edhrec_rank")
SET_COLUMNS = ("name", "set_type", "released_at", "block", "parent_set_code", "card_count", "icon_svg_uri")
PRICE_KEY = ("printing_id", "date", "source", "currency", "price_type")
CURRENT = ("sets", "cards", "faces", "printings", "products", "tags", "deck_cards", "deck_commanders")
#: Histories, and the column by which their folders are divided.
HISTORY = {"prices": "date", "entries": "import_file_id", "ledger": "file_type"}
LEDGER = "id long, file_type string, path string, sha256 string, content_length long, status string, started_at timestamp, rows long, errors long"


class Store(storage.Store):
    """The tables of a catalogue in a folder."""

    def append(self, name: str, df: DataFrame, append_id: str | None = None, by: str | None = None) -> DataFrame:
        """Adds rows to a history, which ``df`` may read; without an id, always."""
        return super().append(name, df, append_id or storage.uuid.uuid4().hex, by or HISTORY[name])

    def load(self) -> Catalogue:
        return Catalogue(**{n: self.current(n) for n in (*CURRENT, *HISTORY)}, store=self)


@dataclass
class Catalogue:
    """Current tables and histories; a missing one is empty."""

    sets: DataFrame | None = None
    cards: DataFrame | None = None
    faces: DataFrame | None = None
    printings: DataFrame | None = None
    prices: DataFrame | None = None
    products: DataFrame | None = None
    entries: DataFrame | None = None
    tags: DataFrame | None = None
    deck_cards: DataFrame | None = None
    deck_commanders: DataFrame | None = None
    ledger: DataFrame | None = None
    quarantine: DataFrame | None = None
    store: Store | None = None
    counters: dict[str, int] = field(default_factory=dict)

    def run(self) -> nullcontext:
        """All changes within are one commit."""
        return self.store.run() if self.store else nullcontext()

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """Replaces a table as a whole."""
        return self.store.keep(name, df) if self.store else written(df, name)

    def change(self, name: str, key: str, stage: DataFrame, how: Callable[[DataFrame | None], DataFrame]) -> DataFrame:
        """Replaces the rows of a table by ``how`` of them; only rows whose key is in
        ``stage`` may be other ones."""
        return self.store.rewrite(name, [key], stage, how) if self.store else written(how(getattr(self, name)), name)

    def upsert(self, name: str, key: str, stage: DataFrame, update: tuple[str, ...], defaults: dict) -> DataFrame:
        return self.change(name, key, stage, lambda held: _merged(held, stage, key, update, defaults))

    def rows_of(self, name: str, stage: DataFrame) -> DataFrame | None:
        """Rows of a table among which are all with a key of ``stage``."""
        return self.store.rows_of(name, stage) if self.store else getattr(self, name)

    def without_append(self, name: str, append_id: str) -> DataFrame | None:
        return self.store.without_append(name, append_id) if self.store else getattr(self, name)

    def append(self, name: str, df: DataFrame, append_id: str) -> tuple[DataFrame, int]:
        """The history with the new rows, and their number."""
        held = getattr(self, name)
        df, seen = ledger.counted(df, f"{name}-added", rows=F.count(F.lit(1)))
        if self.store:
            whole = self.store.append(name, df, append_id)
        else:
            added = written(df, name, (HISTORY[name],))
            whole = added if held is None else held.unionByName(added)
        return whole, seen.get["rows"]


def _staged(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """A table that several steps read, written once, and its number of rows."""
    df, seen = ledger.counted(df, f"{name}-staged", rows=F.count(F.lit(1)))
    return written(df, name), seen.get["rows"]


def _bad(*parts: DataFrame) -> tuple[DataFrame, int]:
    """Quarantined rows as (raw, reason), written, and their number."""
    rows = [x.select((F.col("raw") if "raw" in x.columns else F.to_json(F.struct(*[c for c in x.columns if c != "reason"]))).alias("raw"), "reason") for x in parts]
    whole = rows[0]
    for more in rows[1:]:
        whole = whole.unionByName(more)
    return _staged(whole, "quarantine")


def _merged(target: DataFrame | None, stage: DataFrame, key: str, update: tuple[str, ...], defaults: dict) -> DataFrame:
    """``target`` with ``stage`` upserted; a first run starts from an empty table."""
    if target is None:
        target = stage.select(*(["id"] if "id" in stage.columns else []), key, *update, *[v.alias(c) for c, v in defaults.items()]).limit(0)
    if "id" in stage.columns:
        defaults = {"id": F.col("id"), **defaults}
    return merge.upsert(target, stage, [key], {c: F.col(c) for c in update}, defaults)


def _with_ids(held: Catalogue, name: str, stage: DataFrame, key: str) -> DataFrame:
    """``stage`` with the ids that its keys have in a table, or new ones after the largest."""
    target, rows = getattr(held, name), held.rows_of(name, stage)
    known = rows.select(key, "id") if rows is not None else stage.select(key, F.lit(None).cast("long").alias("id")).limit(0)
    largest = target.agg(F.max("id")).first()[0] if target is not None else None
    return stage.join(merge.surrogate_ids(known, stage, key, "id", largest or 0), key)


def import_sets(spark: SparkSession, path: str, held: Catalogue, run: datetime) -> Catalogue:
    """Sets by code; cards refer to them."""
    good, bad = cards.set_rows(json_files.read_sets(spark, path))
    stage, n = _staged(merge.last_of_each(good, ["code"], ["name"]), "set-stage")
    quarantine, errors = _bad(bad)
    sets = held.upsert("sets", "code", stage, SET_COLUMNS, {})
    return replace(held, sets=sets, quarantine=quarantine, counters={"rows": n, "errors": errors})


def import_cards(spark: SparkSession, path: str, held: Catalogue, run: datetime, day: date, source: str = "bulk") -> Catalogue:
    """Cards, faces, printings and prices from a bulk dump, in one commit.

    Of several records of one card, and of one printing, the last in the file counts.
    Records without an id, printings of a set or card that isn't there, rows that break the
    rules of their table and prices that don't fit are set apart; records without a card key
    are no cards and are left out.
    """
    with held.run():
        return _import_cards(spark, path, held, run, day, source)


def _import_cards(spark: SparkSession, path: str, held: Catalogue, run: datetime, day: date, source: str) -> Catalogue:
    read = written(json_files.read_array(spark, path, schemas.CARD), "read")
    good, bad = json_files.good_and_bad(read, required=("id",))
    records = good.filter("oracle_id is not null and oracle_id <> ''")
    now = F.lit(run)

    taken, refused = constraints.split(cards.card_rows(records, "ord", "raw"), "cards")
    lost = [refused.select("raw", F.concat(F.lit("card: "), "reason").alias("reason"))]
    stage, _ = _staged(merge.last_of_each(taken.drop("raw"), ["oracle_id"], ["ord"]).drop("ord"), "card-rows")
    card_stage, n_cards = _staged(_with_ids(held, "cards", stage, "oracle_id").withColumn("updated_at", now), "card-stage")
    new_cards = held.upsert("cards", "oracle_id", card_stage, (*CARD_COLUMNS, "updated_at"), {"created_at": now, "game_changer": F.lit(False)})
    ids = new_cards.select("oracle_id", F.col("id").alias("card_id"))

    faced = merge.last_of_each(records.filter(F.size("card_faces") > 0).select("oracle_id", "card_faces", "ord"), ["oracle_id"], ["ord"])
    face_rows, refused = constraints.split(cards.face_rows(faced, "oracle_id"), "faces")
    lost.append(refused.select(F.to_json(F.struct("oracle_id", "face_index", "face_name")).alias("raw"), F.concat(F.lit("face: "), "reason").alias("reason")))
    faces = written(links.attach(face_rows, ids, "oracle_id", "card_id").drop("oracle_id"), "faces")
    new_faces = held.change("faces", "card_id", faces, lambda x: faces if x is None else merge.replace_children(x, faces, "card_id"))

    rows, refused = constraints.split(cards.printing_rows(records, "raw", "ord", "prices"), "printings")
    lost.append(refused.select("raw", F.concat(F.lit("printing: "), "reason").alias("reason")))
    last = written(merge.last_of_each(rows, ["scryfall_id"], ["ord"]).drop("ord"), "last-printings")
    rows = last.drop("prices")
    if held.sets is not None:
        rows, without = links.split_by_reference(rows, "set_code", held.sets, "code")
        lost.append(without.select("raw", F.concat(F.lit("no set "), "set_code").alias("reason")))
    lost.append(links.split_by_reference(rows, "oracle_id", ids, "oracle_id")[1].select("raw", F.concat(F.lit("no card "), "oracle_id").alias("reason")))
    rows = written(links.attach(rows.drop("raw"), ids, "oracle_id", "card_id"), "printing-rows")
    stage, n_printings = _staged(_with_ids(held, "printings", rows, "scryfall_id"), "printing-stage")
    update = tuple(c for c in stage.columns if c not in ("id", "scryfall_id"))
    new_printings = held.upsert("printings", "scryfall_id", stage, update, {})
    new_printings = _spread_ids(replace(held, printings=new_printings), stage)

    texts = cards.price_texts(last, F.lit(day), source, "scryfall_id")
    fitting, refused = constraints.split(texts, "prices")
    lost.append(refused.select(F.to_json(F.struct("scryfall_id", "currency", "price_type", "text")).alias("raw"), F.concat(F.lit("price: "), "reason").alias("reason")))
    priced = links.attach(cards.priced(fitting), new_printings.select("scryfall_id", F.col("id").alias("printing_id")), "scryfall_id", "printing_id").drop("scryfall_id")
    # only this day's folder can hold a key of this day; each file of a day is an append of its own
    today = held.prices.filter(F.col("date") == F.lit(day)) if held.prices is not None else priced.limit(0)
    new_prices = merge.insert_absent(today, priced, PRICE_KEY, ["price"])
    prices, n_prices = held.append("prices", new_prices, storage.uuid.uuid4().hex)
    quarantine, errors = _bad(bad, *lost)
    counters = {"cards": n_cards, "printings": n_printings, "prices": n_prices, "errors": errors}
    return replace(held, cards=new_cards, faces=new_faces, printings=new_printings, prices=prices, quarantine=quarantine, counters=counters)


def _spread_ids(held: Catalogue, stage: DataFrame) -> DataFrame:
    """The printings with product ids given to those of the same card, set and number that
    have none; only groups that ``stage`` touches can have changed."""
    keys = ["card_id", "set_code", "collector_number"]
    touched, _ = links.keyed(stage.select(*keys).distinct(), keys)
    groups = held.printings.join(touched, keys, "left_semi")
    without = groups.filter("cardmarket_id is null").select("scryfall_id", *keys)
    known = groups.filter("cardmarket_id is not null").groupBy(*keys).agg(F.min("cardmarket_id").alias("cardmarket_id"))
    filled = written(without.join(known, keys).select("scryfall_id", "cardmarket_id"), "spread")
    return held.change("printings", "scryfall_id", filled, lambda rows: merge.upsert(rows, filled, ["scryfall_id"], ["cardmarket_id"]))


def import_products(spark: SparkSession, path: str, held: Catalogue, run: datetime) -> Catalogue:
    records, unread = json_files.read_wrapped(spark, path, schemas.PRODUCT_LISTS)
    good, bad = market.product_rows(records, "file", "ord")
    good, refused = constraints.split(good, "products")
    now = F.lit(run)
    stage, n = _staged(merge.last_of_each(good, ["id_product"], ["file", "ord"]).drop("file", "ord").withColumns({"last_seen_at": now, "updated_at": now}), "product-stage")
    quarantine, errors = _bad(unread, bad, refused)
    update = tuple(c for c in stage.columns if c != "id_product")
    products = held.upsert("products", "id_product", stage, update, {"first_seen_at": now, "created_at": now})
    return replace(held, products=products, quarantine=quarantine, counters={"rows": n, "errors": errors})


def import_price_guide(spark: SparkSession, path: str, held: Catalogue, run: datetime, import_file: int) -> Catalogue:
    """Appends one snapshot of prices; ids that no product has become null.

    A price that doesn't fit is left out of its entry and counted.  The rows of a file are one
    append under the file's number: importing it again replaces them.
    """
    records, unread = json_files.read_wrapped(spark, path, schemas.PRICE_LISTS)
    good, bad = market.price_entries(records, "file", "ord", overflow="overflow")
    read = written(good, "guide")
    over = read.select(F.to_json(F.struct("id_product", "file", "ord")).alias("raw"), F.explode("overflow").alias("price")).select("raw", F.concat("price", F.lit(" does not fit decimal(12,4)")).alias("reason"))
    stage = read.drop("overflow").withColumns({"import_file_id": F.lit(import_file), "captured_at": F.lit(run)})
    if held.products is not None:
        stage = links.null_out_unknown(stage, "id_product", held.products, "id_product")
    append_id = f"file {import_file}"
    target = held.without_append("entries", append_id)
    if target is None:
        target = stage.withColumn("id", F.lit(None).cast("long")).drop("file", "ord").limit(0)
    own = target.filter(F.col("import_file_id") == import_file)
    largest = target.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    new = merge.insert_absent(own, stage, ["import_file_id", "id_product"], ["file", "ord"]).drop("file", "ord")
    # after all ids that were given, and different within the file
    entries, n = held.append("entries", new.withColumn("id", F.monotonically_increasing_id() + F.lit(largest + 1)), append_id)
    quarantine, errors = _bad(unread, bad, over)
    return replace(held, entries=entries, quarantine=quarantine, counters={"rows": n, "errors": errors})


def delete(held: Catalogue, deleted: dict[str, DataFrame]) -> Catalogue:
    """Deletes the rows of tables that match ``deleted``, with all that refers to them; see
    ``cascades``.  Histories are rewritten as one append."""
    tables = {n: df for n in (*CURRENT, *HISTORY) if (df := getattr(held, n)) is not None}
    left, gone = cascades.delete(tables, deleted)
    changed = {}
    with held.run():
        for name in sorted(n for n in tables if left[n] is not tables[n]):
            if name in HISTORY:
                changed[name] = held.store.replace_history(name, left[name], HISTORY[name]) if held.store else left[name]
            else:
                changed[name] = held.store.replace(name, left[name]) if held.store else left[name]
    return replace(held, **changed, counters={n: df.count() for n, df in gone.items()})


def import_decks(held: Catalogue, listed: DataFrame) -> Catalogue:
    """Rebuilds both tables of deck statistics from (deck_id, commander, card_name)."""
    good, bad = constraints.split(listed.select("deck_id", "commander", "card_name"), "deck_commanders")
    listed, n = _staged(good, "decks")
    quarantine, errors = _bad(bad)
    with held.run():
        deck_cards, deck_commanders = held.keep("deck_cards", decks.card_statistics(listed)), held.keep("deck_commanders", decks.commander_statistics(listed))
    return replace(held, deck_cards=deck_cards, deck_commanders=deck_commanders, quarantine=quarantine, counters={"rows": n, "errors": errors})


def run_if_changed(spark: SparkSession, kind: str, path: str, held: Catalogue, run: datetime, job: Callable[[str, Catalogue], Catalogue]) -> Catalogue:
    """Runs ``job`` on each landed file that no successful import of this kind has taken.

    What a file brings and its row of the ledger are one commit; a file that fails leaves
    nothing but a row that says so.
    """
    landed = written(files.digests(spark, path), "landed")
    new = landed if held.ledger is None else ledger.changed_files(landed, held.ledger, kind)
    wanted = {r["path"] for r in new.select("path").collect()}
    number = 0 if held.ledger is None else held.ledger.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]

    def noted(held: Catalogue, f: object, status: str, counters: dict) -> Catalogue:
        row = (number, kind, f["path"], f["sha256"], f["content_length"], status, run, counters.get("rows", counters.get("printings")), counters.get("errors"))
        return replace(held, ledger=held.append("ledger", spark.createDataFrame([row], LEDGER), f"{kind} {number}")[0])

    for f in landed.orderBy("path").collect():  # of the files that the driver has listed
        number += 1
        if f["path"] not in wanted:
            held = noted(held, f, "skipped_not_modified", {"rows": 0, "errors": 0})
            continue
        before = held
        try:
            with held.run():
                held = job(f["path"], held)
                held = noted(held, f, "success", held.counters)
        except Exception:
            noted(before, f, "failed", {})
            raise
    return held


def latest_price_view(held: Catalogue) -> DataFrame:
    """The newest price entry of each linked printing, with card and product."""
    names = held.cards.select(F.col("id").alias("card_id"), F.col("name").alias("card_name"))
    products = held.products.select("id_product", "en_name", "expansion_name", "number")
    printings = held.printings.select(F.col("id").alias("printing_id"), "scryfall_id", "card_id", "set_code", "collector_number", "lang", "cardmarket_id")
    return latest.latest_prices(printings, names, products, held.entries.drop("raw_json", "import_file_id"))


def enrich(held: Catalogue, responses: DataFrame, names: DataFrame, replace_tags: bool = False) -> tuple[Catalogue, DataFrame]:
    """Tags from responses (set_code, collector_number, name, taggings) to the work-list,
    and flags from listed names: the tables, and the names that no card has, in order."""
    answered = tags.answered(responses, latest.printing_for_tags(held.printings))
    stage = tags.tag_rows(answered, "card_id")
    target = held.tags if held.tags is not None else stage.limit(0)
    stage, refused = constraints.split(stage, "tags")
    stage, _ = _staged(stage, "tag-stage")
    quarantine, errors = _bad(refused)
    flagged, missed = links.flag_by_name(held.cards, names, "game_changer")
    # names are read before the cards change
    missed, _ = _staged(missed, "names-missed")
    old = held.cards.select("oracle_id", F.col("game_changer").alias("_old"))
    turned, _ = _staged(flagged.select("oracle_id", "game_changer").join(old, "oracle_id").filter("game_changer <> _old").drop("_old"), "flags")
    with held.run():
        merged = held.change("tags", "card_id", stage, lambda rows: tags.merge_tags(target if rows is None else rows, stage, "card_id", replace_tags))
        flagged = held.change("cards", "oracle_id", turned, lambda rows: merge.upsert(rows, turned, ["oracle_id"], ["game_changer"]))
    total = links.flag_totals(flagged, "game_changer").first()["flagged"]
    return replace(held, cards=flagged, tags=merged, quarantine=quarantine, counters={"flagged": total} | ({"errors": errors} if errors else {})), links.name_report(missed)
