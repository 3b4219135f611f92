"""A runtime filter: rows whose key cannot be among a few wanted keys go before any exchange."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: bits of a page (one bitmap of the sum), and of the largest filter: 4 MB as an array, whatever the number of keys
PAGE, MOST_BITS = 1 << 15, 1 << 24
#: bits for each key: one row in so many that is not wanted passes, as long as the largest filter is not reached
BITS_PER_KEY = 16
WORD = 32


def filter_bits(keys: DataFrame) -> int:
    """Bits of a filter for a written table of keys."""
    wanted = BITS_PER_KEY * keys.count()
    return min(MOST_BITS, max(PAGE, 1 << (wanted - 1).bit_length()))


def _slot(columns: list[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(bits))


def key_words(keys: DataFrame, columns: list[str], bits: int) -> Column:
    """The bits of the keys' hash slots as one array of 32-bit words, read once when the plan runs.

    The bitmaps are summed where the keys lie before anything is shuffled: a task sends at most bits / PAGE of them,
    however many keys there are.
    """
    slot = _slot(columns, bits)
    pages = keys.groupBy(F.floor(slot / PAGE).cast("int").alias("page")).agg(F.bitmap_construct_agg(slot % PAGE).alias("bits"))
    gathered = pages.agg(F.map_from_entries(F.collect_list(F.struct("page", "bits"))).alias("by_page"))
    empty = F.lit(bytes(PAGE // 8))
    filled = F.transform(F.sequence(F.lit(0), F.lit(bits // PAGE - 1)), lambda page: F.coalesce(F.try_element_at("by_page", page), empty))
    firsts = F.sequence(F.lit(1), F.lit(PAGE // 8), F.lit(WORD // 8))
    word = lambda page, at: F.conv(F.hex(F.substring(page, at, F.lit(WORD // 8))), 16, 10).cast("long")
    return gathered.select(F.flatten(F.transform(filled, lambda page: F.transform(firsts, lambda at: word(page, at)))).alias("words")).scalar()


def may_hold(columns: list[str], words: Column, bits: int) -> Column:
    """False only for keys that are not in the filter; a few others pass."""
    slot = _slot(columns, bits)
    inside = (slot % WORD).cast("int")  # bytes of a word read from the left, bits of a byte from the right
    place = F.lit(WORD - 8) - inside + 2 * (inside % 8)
    return F.bit_get(F.get(words, F.shiftright(slot, WORD.bit_length() - 1).cast("int")), place) == 1


def broadcasts(keys: DataFrame) -> bool:
    """Whether Spark will broadcast a written table by itself, from the table's size."""
    state = keys.sparkSession._jsparkSession.sessionState()
    size = keys._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return size <= state.conf().autoBroadcastJoinThreshold()


def keep_wanted(rows: DataFrame, keys: DataFrame, columns: list[str], bits: int | None = None) -> DataFrame:
    """Rows whose key may be among `keys`, a written table. An inner or semi join on `columns` follows; it drops the few that only
    share a slot.

    Keys that Spark broadcasts meet the rows where these are scanned, so nothing is added. Beyond that size, where the join
    would exchange all rows, the filter cuts them first.
    """
    if bits is None and broadcasts(keys):
        return rows
    bits = bits or filter_bits(keys)
    return rows.filter(may_hold(columns, key_words(keys, columns, bits), bits))
