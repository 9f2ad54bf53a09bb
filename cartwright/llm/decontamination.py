"""Benchmark decontamination by templates, with DataFrame functions only.

A text becomes a list of tokens in which slots are typed: a number, the unit behind it, and a capitalised word inside
a sentence (a name) are marked and keep their value. Each window of WINDOW tokens has three forms:

* typed: slots by their type, other words in lower case. It finds an item again with other numbers, units and names.
* open: like that, but other capitalised words (at the start of a sentence, say) are names too.
* exact: all words and values in lower case. It finds copies in any case, and windows that are mostly slots.

Typed and open windows of an item need LEAST_WORDS words that are no slots, since slots alone say little. Windows of
documents and benchmark items are joined by hashes of their forms.

A match is then checked for consistent slots: along one alignment of document and item, an item value must
always stand for the same document value. Open windows are checked together with all others, and if that fails the
others are checked without them. A document holds an item if consistent alignments cover at least LEAST_COVER of the
item's windows, either of all or of those with enough words, or if an alignment has LEAST_RUN consecutive windows that are
consistent or exact.

Items with the same forms and the same equal values are one template, listed once with all its items.

Defined results: null or empty texts, and items without a word or number, match nothing; an item of fewer tokens than
WINDOW is one window of its whole length, and only exact if it has fewer than LEAST_WORDS. Repeated rows are found alike
and listed once; a null id is listed as null. Documents are joined by id and content hash. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.llm import bitmap
from cartwright.session import materialise

WINDOW = 8
LEAST_WORDS = 4
LEAST_COVER = 0.5
#: Consecutive windows (of 20 tokens together) that are enough in an item of any length.
LEAST_RUN = 13

# Marks of the slot types, from the private use area: a number, a unit, a name, a capitalised word that may be a name.
NUMBER, UNIT, NAME, INITIAL, PAST = "\ue001", "\ue002", "\ue003", "\ue004", "\ue005"
MARKS = f"[{NUMBER}-{INITIAL}]"
EXACT, TYPED, OPEN = 0, 1, 2
# Units of measure and currency that may follow a number.
UNITS = (
    "mm cm dm m km in inch inches ft foot feet yd yards mile miles mg g kg lb lbs oz ounces ton tons ml cl l litre litres "
    "liter liters s sec seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "percent degrees usd eur gbp dollar dollars euro euros cent cents pound pounds"
).split()


def tokens(text: Column) -> Column:
    """The tokens of a text; slots and words that may be names start with the mark of their type."""
    clean = F.regexp_replace(F.coalesce(text, F.lit("")), MARKS, " ")
    capital = F.regexp_replace(clean, r"(?<![\p{L}\p{N}])\p{Lu}", f"{INITIAL}$0")
    named = F.regexp_replace(capital, rf"(?<=[^.!?:\s]\s){INITIAL}", NAME)
    lower = F.lower(named)
    numbers = F.regexp_replace(
        lower, rf"(\d++)(?:\s?+({'|'.join(sorted(UNITS, key=lambda u: (-len(u), u)))})(?!\p{{L}}))?", f" {NUMBER}$1 {UNIT}$2 "
    )
    numbers = F.replace(numbers, F.lit(f"{UNIT} "), F.lit(" "))
    return F.filter(F.split(numbers, rf"[^\p{{L}}\p{{N}}{NUMBER}-{INITIAL}]++"), lambda t: t != "")


def _is_slot(token: Column) -> Column:
    return (token >= F.lit(NUMBER)) & (token < F.lit(INITIAL))


def _is_marked(token: Column) -> Column:
    return (token >= F.lit(NUMBER)) & (token < F.lit(PAST))


def template(tokens_: Column) -> Column:
    """The typed form of each token."""
    return F.transform(
        tokens_,
        lambda t: F.when(_is_slot(t), F.substring(t, 1, 1)).when(_is_marked(t), F.substr(t, F.lit(2))).otherwise(t),
    )


def open_template(tokens_: Column) -> Column:
    """The open form of each token."""
    return F.transform(
        tokens_, lambda t: F.when(_is_slot(t), F.substring(t, 1, 1)).when(_is_marked(t), F.lit(NAME)).otherwise(t)
    )


def exact(tokens_: Column) -> Column:
    """The exact form of each token: its value."""
    return F.transform(tokens_, lambda t: F.when(_is_marked(t), F.substr(t, F.lit(2))).otherwise(t))


def _starts(forms: Column, size: int) -> Column:
    return F.when(F.size(forms) >= size, F.sequence(F.lit(0), F.size(forms) - size)).otherwise(F.array().cast("array<int>"))


def window_hashes(forms: DataFrame, sizes: list[int]) -> DataFrame:
    """doc_id, row, pos, size and hash of every window of the columns typed, open and exact; equal forms of a window are listed once.

    The windows are rows before they are hashed, so that the hashes are compiled code. A row's number holds place and size.
    """
    n = F.size("exact")
    numbered = [
        F.when(n >= size, F.sequence(F.lit(size), (n - size) * 16 + size, F.lit(16))).otherwise(F.array().cast("array<int>"))
        for size in sizes
    ]
    rows = forms.select("doc_id", "row", "typed", "open", "exact", F.explode(F.concat(*numbered)).alias("window"))
    pos, size = F.shiftright("window", 4), F.col("window").bitwiseAND(F.lit(15))
    hashed = lambda kind: F.xxhash64(F.slice(F.col(kind), pos + 1, size)).alias(kind)
    rows = rows.select("doc_id", "row", pos.alias("pos"), size.alias("size"), hashed("typed"), hashed("open"), hashed("exact"))
    worded = F.col("size") >= LEAST_WORDS
    typed = F.when(worded & (F.col("typed") != F.col("exact")), F.col("typed"))
    opened = F.when(worded & (F.col("open") != F.col("typed")) & (F.col("open") != F.col("exact")), F.col("open"))
    rows = rows.select("doc_id", "row", "pos", "size", F.explode(F.array("exact", typed, opened)).alias("hash"))
    return rows.where(F.col("hash").isNotNull())


def templates(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item, item_id (the smallest of the template), item_ids, tokens, typed, open, and members (the distinct exact forms)."""
    items = benchmark.select(F.col(item_id).alias("item_id"), tokens(F.col(text)).alias("tokens")).where(F.size("tokens") > 0)
    items = items.withColumns({"typed": template(F.col("tokens")), "open": open_template(F.col("tokens")), "exact": exact(F.col("tokens"))})
    # The place of the first equal value: items of one template have equal values at the same places.
    equal = F.transform("exact", lambda t, i: F.when(_is_marked(F.get("tokens", i)), F.array_position("exact", t)).otherwise(0))
    # Without enough words there is no template, and an item is one by itself.
    alone = F.when(F.size("tokens") < LEAST_WORDS, F.col("exact"))
    items = items.withColumn("item", F.xxhash64("typed", "open", equal, F.coalesce(alone, F.array().cast("array<string>"))))
    return items.groupBy("item").agg(
        F.min("item_id").alias("item_id"),
        F.array_sort(F.collect_set("item_id")).alias("item_ids"),
        F.min(F.struct("tokens", "typed", "open")).alias("first"),
        F.collect_set("exact").alias("members"),
    ).select("item", "item_id", "item_ids", "first.*", "members")


def item_windows(items: DataFrame) -> DataFrame:
    """item, n_windows, n_word_windows, pos, size, worded, kind, hash and piece (the tokens) of the templates' windows.

    `worded` tells whether the typed form has enough words.
    """
    n_tokens = F.size("tokens")
    result = None
    for size in range(1, WINDOW + 1):
        own = items.where(n_tokens == size if size < WINDOW else n_tokens >= size)

        def window(pos: Column) -> Column:
            def hashed(form: Column, kind: int) -> Column:
                piece = F.slice(form, pos + 1, size)
                words = F.size(F.filter(piece, lambda t: ~_is_slot(t)))
                return F.struct(F.lit(kind).alias("kind"), F.when(words >= LEAST_WORDS, F.xxhash64(piece)).alias("hash"))

            own_typed, own_open = hashed(F.col("typed"), TYPED), hashed(F.col("open"), OPEN)
            copies = F.transform(
                "members", lambda m: F.struct(F.lit(EXACT).alias("kind"), F.xxhash64(F.slice(m, pos + 1, size)).alias("hash"))
            )
            different = F.when(own_typed["hash"].isNull() | (own_typed["hash"] != own_open["hash"]), own_open["hash"])
            others = F.array(own_typed, F.struct(F.lit(OPEN).alias("kind"), different.alias("hash")))
            found = F.filter(F.concat(F.array_distinct(copies), others), lambda h: h["hash"].isNotNull())
            return F.struct(pos.alias("pos"), own_typed["hash"].isNotNull().alias("worded"), found.alias("found"))

        own = own.withColumn("windows", F.transform(_starts(F.col("tokens"), size), window))
        own = own.select(
            "item",
            "tokens",
            F.size("windows").alias("n_windows"),
            F.size(F.filter("windows", lambda w: w["worded"])).alias("n_word_windows"),
            F.lit(size).alias("size"),
            F.explode("windows").alias("w"),
        )
        result = own if result is None else result.unionByName(own)
    piece = F.slice("tokens", F.col("w.pos") + 1, F.col("size"))
    result = result.select(
        "item", "n_windows", "n_word_windows", "w.pos", "size", "w.worded", piece.alias("piece"), F.explode("w.found").alias("h")
    )
    return result.select("item", "n_windows", "n_word_windows", "pos", "size", "worded", "h.kind", "h.hash", "piece")


def find_items(docs: DataFrame, benchmark: DataFrame, least_cover: float = LEAST_COVER) -> DataFrame:
    """One row for each document and template it holds.

    The columns are doc_id, row, item_id, item_ids, n_windows, n_matched, cover and reparameterised. `row` is a hash of id
    and text, `reparameterised` tells whether a slot has another value than in every item of the template.
    """
    items = materialise(templates(benchmark), "items")
    own_windows = materialise(item_windows(items), "item-windows")
    # At most WINDOW values.
    sizes = sorted(r["size"] for r in own_windows.select("size").distinct().collect())
    source = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")
    hashes = materialise(own_windows.select(F.col("hash").alias("item_hash")).distinct(), "item-hashes")
    forms = source.select("doc_id", "row", tokens(F.col("text")).alias("tokens"))
    forms = forms.select(
        "doc_id",
        "row",
        template(F.col("tokens")).alias("typed"),
        open_template(F.col("tokens")).alias("open"),
        exact(F.col("tokens")).alias("exact"),
    )
    hits = window_hashes(forms, sizes or [WINDOW])
    # A bitmap of the hashes is sent to the texts, so that few windows are joined.
    hits = bitmap.within(hits, "hash", hashes, "item_hash").join(hashes, F.col("hash") == F.col("item_hash"), "left_semi")
    hits = materialise(hits.distinct(), "window-hits")
    found = hits.select(F.col("row").alias("hit_row")).distinct()
    # A bitmap of the rows with hits keeps the other texts out of the shuffle.
    maybe, _ = bitmap.split(source, "row", found, "hit_row")
    texts = maybe.join(found, F.col("row") == F.col("hit_row"), "left_semi").dropDuplicates(["row"])
    texts = texts.select(F.col("row").alias("text_row"), exact(tokens(F.col("text"))).alias("tokens"))
    theirs = own_windows.select(
        "item",
        "n_windows",
        "n_word_windows",
        "worded",
        "kind",
        F.col("pos").alias("item_pos"),
        F.col("hash").alias("item_hash"),
        F.col("piece").alias("item_piece"),
    )
    matched = (
        hits.join(texts, F.col("row") == F.col("text_row"))
        .withColumn("piece", F.slice("tokens", F.col("pos") + 1, F.col("size")))
        .join(theirs, F.col("hash") == F.col("item_hash"))
        .withColumn("shift", F.col("pos") - F.col("item_pos"))
        .groupBy("row", "item", "shift", "item_pos")
        .agg(
            F.min("kind").alias("kind"),
            F.first("doc_id").alias("doc_id"),
            F.max("n_windows").alias("n_windows"),
            F.max("n_word_windows").alias("n_word_windows"),
            F.max("worded").alias("worded"),
            F.first("piece").alias("piece"),
            F.first("item_piece").alias("item_piece"),
        )
    )
    matched = materialise(matched, "window-matches")
    alignment = ["row", "item", "shift"]
    slots = matched.select(*alignment, "kind", F.explode(F.arrays_zip("item_piece", "piece")).alias("s"))
    slots = slots.where(_is_marked(F.col("s.item_piece")))
    typed = F.when((F.col("kind") != OPEN) & _is_slot(F.col("s.item_piece")), F.col("s.piece"))
    values = slots.groupBy(*alignment, F.substr(F.col("s.item_piece"), F.lit(2)).alias("value")).agg(
        F.min("s.piece").alias("low"), F.max("s.piece").alias("high"), F.min(typed).alias("typed_low"), F.max(typed).alias("typed_high")
    )
    verdicts = values.groupBy(*alignment).agg(
        F.max(F.col("low") != F.col("high")).alias("mixed"), F.max(F.col("typed_low") != F.col("typed_high")).alias("typed_mixed")
    )
    mixed = F.coalesce(F.when(F.col("kind") == OPEN, F.col("mixed")).otherwise(F.col("typed_mixed")), F.lit(False))
    checked = matched.join(verdicts, alignment, "left").withColumn("good", ~mixed).where(F.col("good") | (F.col("kind") == EXACT))
    # Positions minus their rank are equal within a run.
    rank = F.row_number().over(Window.partitionBy(*alignment).orderBy("item_pos"))
    checked = materialise(checked.withColumn("run", F.col("item_pos") - rank), "checked-matches")
    runs = checked.groupBy(*alignment, "run").agg(F.count(F.lit(1)).alias("length"))
    runs = runs.where(F.col("length") >= LEAST_RUN).select(*alignment, "run", F.lit(True).alias("long"))
    counted = checked.join(runs, [*alignment, "run"], "left").withColumn("long", F.coalesce("long", F.lit(False)))
    counted = counted.where("good OR long")
    covered = counted.groupBy("row", "item").agg(
        F.first("doc_id").alias("doc_id"),
        F.max("n_windows").alias("n_windows"),
        F.max("n_word_windows").alias("n_word_windows"),
        F.count_distinct("item_pos").alias("n_matched"),
        F.count_distinct(F.when(F.col("worded"), F.col("item_pos"))).alias("n_word_matched"),
        F.max("long").alias("long"),
        F.max(F.col("kind") != EXACT).alias("reparameterised"),
    )
    share = lambda matched, whole: F.struct(
        F.when(F.col(whole) > 0, F.col(matched) / F.col(whole)).otherwise(0.0).alias("cover"),
        F.col(matched).alias("n_matched"),
        F.col(whole).alias("n_windows"),
    )
    best = F.greatest(share("n_matched", "n_windows"), share("n_word_matched", "n_word_windows"))
    held = covered.select("doc_id", "row", "item", "long", "reparameterised", best.alias("best"))
    held = held.where((F.col("best.cover") >= least_cover) | F.col("long"))
    held = held.join(items.select("item", "item_id", "item_ids"), "item")
    return held.select("doc_id", "row", "item_id", "item_ids", "best.n_windows", "best.n_matched", "best.cover", "reparameterised")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_windows, n_matched, cover, reparameterised and item_ids, one row per document and template."""
    found = find_items(docs, benchmark)
    return found.select("doc_id", "item_id", "n_windows", "n_matched", "cover", "reparameterised", "item_ids")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a benchmark item, with their columns."""
    found = materialise(find_items(docs, benchmark).select(F.col("row").alias("found_row")).distinct(), "contaminated")
    whole = docs.select(F.struct(*docs.columns).alias("doc"), F.xxhash64("doc_id", "text").alias("row"))
    maybe, rest = bitmap.split(whole, "row", found, "found_row")
    left = maybe.join(found, F.col("row") == F.col("found_row"), "left_anti")
    return rest.unionByName(left).select("doc.*")
