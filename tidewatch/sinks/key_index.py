"""An index of the keys that a ledger holds, so that a batch reads only what may hold its own.

Every batch adds a part: the 16-byte hashes of its keys, sorted and cut into
slots of the hash range, and a Bloom filter for them. Parts of one size are
merged into one of the next, so that their number grows with the logarithm of
the history. A lookup tests the batch's keys against the filters of the slots
they fall into and opens the key files of those slots alone that may hold one.
A batch whose keys are many beside the stored ones would open all slots anyway,
so it is joined with them at once.

Layout below the ledger's path:

    keys/data/<part>/slot=<n>/    hi, lo (the hash), run, batch_id
    keys/bloom/<part>/slot=<n>/   block, bits: a bitmap for each block of the hash range
    keys/live/<part>.json         says that a part is complete, and which others it replaces
    keys/open/<run>,<batch>       a batch that is being written, whose keys are not yet here
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.operators.shuffles import is_small
from tidewatch.sinks.parts import GRACE, PartLog

#: Keys of a slot, about; 24 bytes each in a task and in a file.
SLOT_KEYS = 4_000_000
#: Keys that one task sorts and sets the bits of, about.
TASK_KEYS = 250_000
#: Keys of a block of the filter. Spark's bitmaps have 32,768 bits, 16 for each key.
BLOCK_KEYS = 2048
BITMAP_BITS = 32768
#: Bits that a key sets in its block: with 16 bits a key about one in 2,000 is found by mistake.
PROBES = 6
#: Parts of one level that are merged into one of the next.
FAN_IN = 8
#: A batch too large for a broadcast is joined with the stored keys themselves, if these are at most so many times as many.
DIRECT = 8

_DATA = "hi bigint, lo bigint, run string, batch_id bigint, slot int"
_BLOOM = "block bigint, bits binary, slot int"


def hashed(*keys: str) -> list[Column]:
    """The key as 128 bits in two numbers; which text belongs to which column makes a difference."""
    parts = [F.concat(F.octet_length(k).cast("string"), F.lit(":"), F.col(k)) for k in keys]
    digest = F.sha2(F.concat(*[F.coalesce(p, F.lit("-")) for p in parts]).cast("binary"), 256)
    return [
        F.conv(F.substring(digest, at, 16), 16, -10).cast("bigint").alias(name) for at, name in ((1, "hi"), (17, "lo"))
    ]


def _range_of(bits: int) -> Column:
    """The part of the hash range, cut into 2^bits, that a key falls into."""
    return F.shiftrightunsigned("hi", 64 - bits) if bits else F.lit(0).cast("bigint")


def _probes() -> Column:
    """Places in a block's bitmap, from bits of the hash that do not choose the block."""
    return F.array(*[F.shiftrightunsigned("lo", 15 * i).bitwiseAND(F.lit(BITMAP_BITS - 1)) for i in range(4)],
                   F.col("hi").bitwiseAND(F.lit(BITMAP_BITS - 1)),
                   F.shiftrightunsigned("hi", 15).bitwiseAND(F.lit(BITMAP_BITS - 1)))


def _all_set(bits: Column) -> Column:
    """Whether a bitmap has the bits of all probes."""
    def is_set(place: Column) -> Column:
        byte = F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))
        return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(place, F.lit(8)).cast("int")) == 1

    return F.forall(_probes(), is_set)


def _bits_for(keys: int, each: int) -> int:
    """The number of bits that cut the hash range so that about so many keys share a part."""
    return max(0, (max(1, -(-keys // each)) - 1).bit_length())


@dataclass(frozen=True)
class Part:
    """A complete set of keys: its files, how its hash range is cut, and what was merged into it."""

    name: str
    level: int
    keys: int
    slot_bits: int
    block_bits: int
    batches: list[list] = field(default_factory=list)  # run, batch of a part that was never merged
    replaces: list[str] = field(default_factory=list)


@dataclass
class Looked:
    """What a lookup read: parts, slots whose filters it took, and slots whose keys it opened."""

    parts: int = 0
    slots: int = 0
    opened: int = 0


class KeyIndex:
    """The keys stored under a ledger's path.

    begin() marks a batch as being written, add() makes its keys known and
    end() takes the mark away; a batch that died between is looked up in the
    ledger itself. Keys carry the run and batch that stored them, so a batch
    that is replayed never meets its own, merged or not.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], fan_in: int = FAN_IN, slot_keys: int = SLOT_KEYS):
        self.spark, self.root, self.keys = spark, f"{path.rstrip('/')}/keys", tuple(keys)
        self.log = PartLog(spark, self.root, ("data", "bloom"))
        self.fan_in, self.slot_keys = fan_in, slot_keys
        self.looked, self._held = Looked(), []

    # parts -----------------------------------------------------------------

    def exists(self) -> bool:
        return self.log.exists()

    def live(self) -> list[Part]:
        return [Part(**p) for p in self.log.live()]

    def _write(self, rows: DataFrame, name: str, level: int, n: int, **more) -> Part:
        """Key files and filter of hi, lo, run, batch_id; the part lives once its file in live/ is there."""
        slot_bits, block_bits = _bits_for(n, self.slot_keys), _bits_for(n, BLOCK_KEYS)
        slotted = rows.withColumn("slot", _range_of(slot_bits).cast("int"))
        slots, task_bits = 1 << slot_bits, max(slot_bits, _bits_for(n, TASK_KEYS))
        # not coalesce, which runs all tasks before it, and their sorts, within one
        dealt = slotted.repartition(1 << task_bits, _range_of(task_bits)) if task_bits else slotted.repartition(1)
        data = f"{self.root}/data/{name}"
        dealt.sortWithinPartitions("slot", "hi", "lo").write.mode("overwrite").partitionBy("slot").parquet(data)
        stored = self.spark.read.schema(_DATA).parquet(data).withColumn("task", _range_of(task_bits))
        own = stored.repartition(1 << task_bits, "task") if task_bits else stored.repartition(1)
        places = own.select("task", "slot", _range_of(block_bits).alias("block"), _probes().alias("places"))
        # a bitmap for each probe, so that keys are sorted by block once and not once a probe
        each = [F.expr(f"bitmap_construct_agg(places[{i}])") for i in range(PROBES)]
        probed = places.groupBy("task", "slot", "block").agg(F.array(*each).alias("each"))
        blocks = probed.select("task", "slot", "block", F.explode("each").alias("bits")).groupBy("task", "slot", "block").agg(
            F.expr("bitmap_or_agg(bits)").alias("bits")
        ).drop("task")
        dealt = blocks.repartition(slots, "slot")
        dealt.sortWithinPartitions("slot", "block").write.mode("overwrite").partitionBy("slot").parquet(f"{self.root}/bloom/{name}")
        part = Part(name, level, n, slot_bits, block_bits, **more)
        self.log.add(asdict(part))
        return part

    # batches ---------------------------------------------------------------

    @staticmethod
    def _mark(run: str, batch: int) -> str:
        return f"{run},{batch}"

    def begin(self, run: str, batch: int) -> None:
        self.log.put("open", self._mark(run, batch))

    def end(self, run: str, batch: int) -> None:
        self.log.remove("open", self._mark(run, batch))

    def unindexed(self, run: str, batch: int) -> list[tuple[str, int]]:
        """Other batches whose rows may be stored while their keys are not here."""
        marks = [n.rsplit(",", 1) for n in self.log.names("open")]
        return [(r, int(b)) for r, b in marks if (r, int(b)) != (run, batch)]

    def add(self, rows: DataFrame, run: str, batch: int) -> Part:
        """Make the keys of a batch known. A batch that is added again replaces what it added."""
        keys = rows.select(*hashed(*self.keys), F.lit(run).alias("run"), F.lit(batch).cast("bigint").alias("batch_id"))
        before = [p.name for p in self.live() if p.batches == [[run, batch]]]
        return self._write(keys, f"0-{uuid.uuid4().hex}", 0, keys.count(), batches=[[run, batch]], replaces=before)

    def build(self, ledger: DataFrame) -> None:
        """Index a ledger that was written without one."""
        keys = ledger.select(*hashed(*self.keys), "run", "batch_id")
        n = keys.count()
        self._write(keys, f"0-{uuid.uuid4().hex}", _bits_for(n, SLOT_KEYS), n)

    def merge(self) -> None:
        """Merge the parts of a level that has become full, level by level; each key is moved once a level."""
        while True:
            levels: dict[int, list[Part]] = {}
            for p in self.live():
                levels.setdefault(p.level, []).append(p)
            full = next((parts for _, parts in sorted(levels.items()) if len(parts) >= self.fan_in), None)
            if full is None:
                return
            rows = self._read([(p, None) for p in full]).drop("slot")
            self._write(
                rows, f"{full[0].level + 1}-{uuid.uuid4().hex}", full[0].level + 1, sum(p.keys for p in full),
                replaces=[p.name for p in full],
            )

    def sweep(self, grace: float = GRACE) -> int:
        return self.log.sweep(grace)

    # lookup ----------------------------------------------------------------

    def _read(self, wanted: list[tuple[Part, list[int] | None]]) -> DataFrame:
        """The keys of the given slots of one or more parts; None stands for all."""
        out = None
        for p, slots in wanted:
            rows = self.spark.read.schema(_DATA).parquet(f"{self.root}/data/{p.name}")
            rows = rows if slots is None else rows.filter(F.col("slot").isin(slots))
            out = rows if out is None else out.unionByName(rows)
        return out

    def _maybe(self, batch: DataFrame, parts: list[Part], slots: list[list[int]]) -> DataFrame:
        """part, slot, hi, lo of the keys that a filter cannot rule out."""
        blocks = None
        for i, (p, own) in enumerate(zip(parts, slots, strict=True)):
            rows = self.spark.read.schema(_BLOOM).parquet(f"{self.root}/bloom/{p.name}").filter(F.col("slot").isin(own))
            rows = rows.select(F.lit(i).alias("part"), "slot", "block", "bits")
            blocks = rows if blocks is None else blocks.unionByName(rows)
        at = F.array(*[F.struct(F.lit(i).alias("part"), _range_of(p.block_bits).alias("block")) for i, p in enumerate(parts)])
        keys = batch.select("hi", "lo", F.explode(at).alias("at")).select("hi", "lo", "at.*")
        return blocks.join(F.broadcast(keys) if is_small(keys) else keys, ["part", "block"]).filter(
            _all_set(F.col("bits"))
        ).select("part", "slot", "hi", "lo")

    def _slots(self, batch: DataFrame, parts: list[Part]) -> list[list[int]]:
        """The slots of each part that the batch's keys fall into."""
        slots: list[list[int]] = [[] if p.slot_bits else [0] for p in parts]
        cut = [(i, p) for i, p in enumerate(parts) if p.slot_bits]
        if cut:
            at = F.array(*[F.struct(F.lit(i).alias("part"), _range_of(p.slot_bits).alias("slot")) for i, p in cut])
            for r in batch.select(F.explode(at).alias("at")).select("at.*").distinct().collect():
                slots[r["part"]].append(r["slot"])
        return slots

    def known(self, batch: DataFrame, run: str, batch_id: int) -> DataFrame | None:
        """hi and lo of those keys of the batch that other batches stored before; None if there are none.
        With a batch that is joined directly, all stored keys.

        batch: hi and lo, each key once, of this batch. Its slots reach the
        driver as numbers, at most as many as the parts have.
        """
        self.looked = Looked()
        parts = [p for p in self.live() if p.keys and p.batches != [[run, batch_id]]]
        if not parts:
            return None
        if not is_small(batch) and sum(p.keys for p in parts) <= DIRECT * batch.count():
            self.looked = Looked(len(parts), 0, sum(1 << p.slot_bits for p in parts))
            return self._read([(p, None) for p in parts]).filter(
                (F.col("run") != run) | (F.col("batch_id") < batch_id)
            ).select("hi", "lo").hint("merge")
        slots = self._slots(batch, parts)
        maybe = self._maybe(batch, parts, slots).persist(StorageLevel.MEMORY_AND_DISK)
        self._held.append(maybe)
        opened: dict[int, list[int]] = {}
        for r in maybe.select("part", "slot").distinct().collect():
            opened.setdefault(r["part"], []).append(r["slot"])
        self.looked = Looked(len(parts), sum(map(len, slots)), sum(map(len, opened.values())))
        if not opened:
            return None
        stored = self._read([(parts[i], own) for i, own in opened.items()]).filter(
            (F.col("run") != run) | (F.col("batch_id") < batch_id)
        ).select("hi", "lo")
        wanted = maybe.select("hi", "lo").distinct()
        return stored.join(F.broadcast(wanted) if is_small(wanted) else wanted, ["hi", "lo"], "left_semi").distinct()

    def release(self) -> None:
        """Give back what lookups hold in memory."""
        while self._held:
            self._held.pop().unpersist()
