"""URL filters by a cascade of Bloom filters: exact membership of keys in lists, without a join.

A key is a host or one of its parent domains, with or without the beginning of a path. All keys that the corpus's
urls can ask for are its universe. The first filter of a cascade holds the listed keys, the second those keys of the
universe that the first one takes for listed, the third those listed keys that the second one takes for these, and so
on until no key is mistaken: within the universe the answer is exact. Keys are dealt by hash into shards of a
bounded number, a task builds a shard's cascades, and urls are judged where they are: a task reads the shards that
its keys fall in and holds a bounded number of bytes of them.
"""

from __future__ import annotations

import math
from collections import OrderedDict

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodewright.llm.tables import lower_ascii, open_folder, written

# Keys of the universe in a shard, as expected; its filters are far smaller.
SHARD_KEYS = 1 << 20
# Bytes of cascades that a task holds at once.
HELD_BYTES = 64 << 20
# More levels than any cascade needs; keys whose 128-bit hashes are equal would never part.
LEVELS = 200
# Host names have no more characters.
HOST_CHARS = 253
ALLOW, BLOCK, LISTED = 0, 1, 2

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(keys: list[str], kinds: list[int]) -> np.ndarray:
    """Two words of 64 bits per key."""
    digests = [xxhash.xxh3_128_digest(k.encode("utf-8", "surrogatepass"), seed=s) for k, s in zip(keys, kinds)]
    return np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)


class Level:
    """A Bloom filter over rows of ``hashes``; each level of a cascade mixes them anew."""

    def __init__(self, number: int, count: int, bits: np.ndarray):
        self.number, self.count, self.bits = number, count, bits

    @classmethod
    def of(cls, number: int, held: np.ndarray, others: int) -> Level:
        """A filter of the held keys. Fewer mistakes pay where the keys to tell from them are many."""
        rate = min(0.5, len(held) * math.sqrt(0.5) / others) if number == 0 and others else 0.5
        words = -(-int(math.ceil(len(held) * -math.log(rate) / math.log(2) ** 2)) // 8) + 1
        count = max(1, round(words * 8 / len(held) * math.log(2)))
        level = cls(number, count, np.zeros(words, np.uint8))
        spots = np.concatenate(list(level._spots(held)))
        np.bitwise_or.at(level.bits, spots >> np.uint64(3), np.uint8(1) << (spots & np.uint64(7)).astype(np.uint8))
        return level

    def _spots(self, keys: np.ndarray):
        with np.errstate(over="ignore"):
            one = _mixed(keys[:, 0] + np.uint64(self.number) * _ODD)
            two = _mixed(keys[:, 1] ^ one) | np.uint64(1)
            for i in range(self.count):
                yield (one + np.uint64(i) * two) % np.uint64(len(self.bits) * 8)

    def passed(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for spots in self._spots(keys):
            found &= self.bits[spots >> np.uint64(3)] >> (spots & np.uint64(7)).astype(np.uint8) & 1 == 1
        return found


def levels(listed: np.ndarray, others: np.ndarray) -> list[Level]:
    """The cascade of listed keys among others; none if nothing is listed."""
    out: list[Level] = []
    held, told_from = listed, others
    while len(held):
        if len(out) == LEVELS:
            raise ValueError("two keys have one hash")
        out.append(Level.of(len(out), held, len(told_from)))
        held, told_from = told_from[out[-1].passed(told_from)], held
    return out


def listed_by(cascade: list[Level], keys: np.ndarray) -> np.ndarray:
    """Which keys are listed: those whose first filter that doesn't hold them has an even number, counted from 1.

    A key that all filters hold belongs to those that the last one was made of.
    """
    found = np.zeros(len(keys), bool)
    rows = np.arange(len(keys))
    for number, level in enumerate(cascade):
        rows = rows[level.passed(keys[rows])]
        found[rows] = number % 2 == 0
    return found


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z in lower case, and the path of a url; both empty without ``://``, or for a null."""
    at = F.locate("://", url)
    after = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    after = F.coalesce(after, F.lit(""))
    host = lower_ascii(F.regexp_extract(after, r"^[^/?#]*", 0))
    return host, F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def domains(host: Column) -> Column:
    """The host and all its parent domains, longest first; none has over HOST_CHARS characters."""
    end = F.when(F.length(host) <= HOST_CHARS, host).otherwise(
        F.regexp_replace(F.substring(host, -(HOST_CHARS + 1), HOST_CHARS + 1), r"^[^.]*\.?", "")
    )
    labels = F.split(end, r"\.", -1)
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )


def _beginnings(names: Column, path: Column, sizes: list[int]) -> Column:
    """Each domain with each beginning of the path that a rule may have, longest first, ties to the longer domain."""
    both = F.flatten(
        F.transform(
            names,
            lambda name: F.filter(
                F.array(
                    *(
                        F.when(F.length(path) >= size, F.concat(name, F.substring(path, 1, size)))
                        for size in sorted(sizes, reverse=True)
                    )
                ),
                lambda key: key.isNotNull(),
            ),
        )
    )
    return F.array_sort(
        F.transform(both, lambda key: F.struct((-F.length(key)).alias("n"), (-F.locate("/", key)).alias("at"), key.alias("key")))
    )["key"]


def _universe(asked: DataFrame, rules: DataFrame, listed: DataFrame) -> DataFrame:
    """(kind, key, held): the distinct keys that urls ask for, and in which lists each is. Kind 1: domains."""
    own = asked.select(F.explode("rule_keys").alias("key"), F.lit(0).alias("kind")).unionAll(
        asked.select(F.explode("names").alias("key"), F.lit(1).alias("kind"))
    )
    blocked = F.coalesce(F.col("verdict") == "block", F.lit(False))
    lists = rules.select(F.concat("host", "path").alias("key"), F.lit(0).alias("kind"),
                         F.when(blocked, 1 << BLOCK).otherwise(1 << ALLOW).alias("held"))
    lists = lists.unionAll(listed.select("key", F.lit(1).alias("kind"), F.lit(1 << LISTED).alias("held")))
    every = own.select("key", "kind", F.lit(0).alias("held"), F.lit(1).alias("asked")).unionAll(
        lists.where("key is not null").select("key", "kind", "held", F.lit(0).alias("asked"))
    )
    kept = every.groupBy("kind", "key").agg(F.bit_or("held").alias("held"), F.max("asked").alias("asked"))
    return kept.where("asked = 1").drop("asked")


def build(universe: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """(shard, list, number, count, bits): the filters of all shards, written. A key's first hash names its shard.

    ``universe`` has (kind, key, held), with held a bit set of lists; a key that is in ALLOW and BLOCK is in BLOCK.
    """
    universe = written(universe, "universe")
    shards = max(1, -(-universe.count() // shard_keys))

    def hashed(batches):
        for batch in batches:
            both = hashes(batch.column(1).to_pylist(), batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((both[:, 0] % np.uint64(shards)).astype(np.int64)),
                    pa.array(both[:, 0].astype(np.int64)),
                    pa.array(both[:, 1].astype(np.int64)),
                    batch.column(2),
                ],
                ["shard", "one", "two", "held"],
            )

    def cascades(shard, parts):
        keys = np.concatenate([p[0] for p in parts])
        held = np.concatenate([p[1] for p in parts])
        held = np.where(held >> BLOCK & 1, held & ~np.int64(1 << ALLOW), held)
        for name in (ALLOW, BLOCK, LISTED):
            member = held >> name & 1 == 1
            for level in levels(keys[member], keys[~member]):
                yield pa.RecordBatch.from_pydict(
                    {"shard": pa.array([shard], pa.int64()), "list": pa.array([name], pa.int32()), "number": pa.array([level.number], pa.int32()),
                     "count": pa.array([level.count], pa.int32()), "bits": pa.array([level.bits.tobytes()], pa.binary())}
                )

    def made(batches):
        now, parts = None, []
        for batch in batches:
            shard = batch.column(0).to_numpy()
            both = np.stack([batch.column(i).to_numpy().view(np.uint64) for i in (1, 2)], axis=1)
            held = batch.column(3).to_numpy().astype(np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
            for first, last in zip(cuts[:-1], cuts[1:]):
                if first == last:
                    continue
                if now is not None and shard[first] != now:
                    yield from cascades(now, parts)
                    parts = []
                now = int(shard[first])
                parts.append((both[first:last], held[first:last]))
        if now is not None:
            yield from cascades(now, parts)

    dealt = universe.select("kind", "key", "held").mapInArrow(hashed, "shard long, one long, two long, held int")
    dealt = dealt.repartition(shards, "shard").sortWithinPartitions("shard")
    made_of = dealt.mapInArrow(made, "shard long, list int, number int, count int, bits binary")
    filters = written(made_of, "cascades")
    filters.shards = shards
    return filters


class Shards:
    """Reads shards of written cascades, and holds the last ones up to HELD_BYTES."""

    def __init__(self, path: str):
        source, folder = open_folder(path)
        self.files = ds.dataset(folder, filesystem=source, format="parquet")
        self.held: OrderedDict[int, tuple[dict[int, list[Level]], int]] = OrderedDict()

    def __getitem__(self, shard: int) -> dict[int, list[Level]]:
        if shard not in self.held:
            rows = self.files.to_table(filter=ds.field("shard") == shard).sort_by([("list", "ascending"), ("number", "ascending")])
            lists: dict[int, list[Level]] = {}
            for row in rows.to_pylist():
                level = Level(row["number"], row["count"], np.frombuffer(row["bits"], np.uint8))
                lists.setdefault(row["list"], []).append(level)
            self.held[shard] = lists, rows.nbytes
            while len(self.held) > 1 and sum(n for _, n in self.held.values()) > HELD_BYTES:
                self.held.popitem(last=False)
        self.held.move_to_end(shard)
        return self.held[shard][0]

    def listed(self, keys: np.ndarray, shards: int) -> dict[int, np.ndarray]:
        """For each list, which rows of ``hashes`` it has."""
        out = {name: np.zeros(len(keys), bool) for name in (ALLOW, BLOCK, LISTED)}
        shard = (keys[:, 0] % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        cuts = [0, *(np.flatnonzero(np.diff(shard[order])) + 1).tolist(), len(order)]
        for first, last in zip(cuts[:-1], cuts[1:]):
            if first < last:
                rows = order[first:last]
                for name, cascade in self[int(shard[rows[0]])].items():
                    out[name][rows] = listed_by(cascade, keys[rows])
        return out


def _first(lists: pa.ListArray, found: np.ndarray) -> np.ndarray:
    """For each row the index of its first value that is found, or -1."""
    ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    hits = np.flatnonzero(found)
    at = np.searchsorted(hits, ends[:-1])
    first = np.append(hits, -1)[at]
    return np.where((first >= 0) & (first < ends[1:]), first, -1)


def judge(
    frame: DataFrame,
    rules: DataFrame,
    listed: DataFrame | None = None,
    key: str = "page_id",
    url: str = "url",
    shard_keys: int = SHARD_KEYS,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, listed) of every row.

    ``rules`` has (host, path, verdict): a rule fits its host and all subdomains of it, if the url's path starts with
    its own; the longest one wins, ties to the longer host, then to a block. ``listed`` has (key): domains that,
    with their subdomains, are blocked where no rule fits; all else is allowed. ``listed`` tells if the host is.

    A null url, or one without ``://``, has an empty host and path. Hosts of rules and lists are host names of at
    most 253 characters; longer ones fit nothing, though hosts of any length are judged by their ends. Rows with null
    hosts, paths or keys in rules and lists are left out. Repeated rows are judged each; an empty table gives no rows,
    without rules and lists all is allowed, and other columns are not looked at.
    """
    spark = frame.sparkSession
    if listed is None:
        listed = spark.createDataFrame([], "key string")
    rules = rules.select("host", "path", "verdict").where("instr(host, '/') = 0 and (path = '' or path like '/%')")
    sizes = [r[0] for r in rules.select(F.length("path")).distinct().collect()]
    host, path = host_and_path(frame[url])
    asked = frame.select(frame[key].alias("page_id"), host.alias("host"), path.alias("path"))
    asked = asked.withColumn("names", domains(F.col("host")))
    beginnings = _beginnings(F.col("names"), F.col("path"), sizes) if sizes else F.array().cast("array<string>")
    asked = asked.withColumn("rule_keys", beginnings)
    filters = build(_universe(asked, rules, listed), shard_keys)
    stored, shards = filters.written_at, filters.shards

    def decide(batches):
        cascades = Shards(stored)
        for batch in batches:
            found = []
            for kind, column in ((1, 3), (0, 4)):
                flat = batch.column(column).flatten().dictionary_encode()
                keys = hashes(flat.dictionary.to_pylist(), [kind] * len(flat.dictionary))
                held = cascades.listed(keys, shards) if len(keys) else {}
                at = flat.indices.to_numpy()
                found.append((batch.column(column), flat, {n: h[at] for n, h in held.items()}))
            (names, _, domain), (keys, flat, ruled) = found
            rows = batch.num_rows
            in_list = _first(names, domain[LISTED]) >= 0 if domain else np.zeros(rows, bool)
            best = _first(keys, ruled[ALLOW] | ruled[BLOCK]) if ruled else np.full(rows, -1)
            fits = best >= 0
            blocked = np.where(fits, ruled[BLOCK][best], in_list) if ruled else in_list
            rule = flat.take(pa.array(best, mask=~fits)).cast(pa.string()) if len(flat) else pa.nulls(rows, pa.string())
            verdict = pa.array(np.where(blocked, "block", "allow"), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), rule, verdict, pa.array(in_list)],
                ["page_id", "host", "path", "rule", "verdict", "listed"],
            )

    return asked.select("page_id", "host", "path", "names", "rule_keys").mapInArrow(
        decide, "page_id long, host string, path string, rule string, verdict string, listed boolean"
    )


# The rules that the query applies.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
# The query's list: domains whose first label has one of these words between hyphens.
WORDS = ["adult", "ads", "bets", "casino", "pills", "spam"]


def listed_domains(frame: DataFrame, words: list[str], url: str = "url") -> DataFrame:
    """(key): the domains of the urls whose first label has one of the words between hyphens."""
    host, _ = host_and_path(frame[url])
    names = frame.select(F.explode(domains(host)).alias("key")).distinct()
    label = F.split(F.split("key", r"\.")[0], "-")
    return names.where(F.arrays_overlap(label, F.array(*map(F.lit, words))))


ORACLE = r"""
WITH parts AS (
  SELECT page_id,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fitting AS (
  SELECT DISTINCT host, path,
    first_value(rule_host || rule_path) OVER best AS rule, first_value(rule_verdict) OVER best AS rule_verdict
  FROM (SELECT DISTINCT host, path FROM split) JOIN rules
    ON ends_with('.' || host, '.' || rule_host) AND starts_with(path, rule_path)
  WINDOW best AS (PARTITION BY host, path ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC)
), judged AS (
  SELECT page_id, host, path, rule, rule_verdict,
    regexp_matches(host, '(^|\.)([^.]*-)?(adult|ads|bets|casino|pills|spam)(-[^.]*)?(\.|$)') AS listed
  FROM split LEFT JOIN fitting USING (host, path)
)
SELECT page_id, host, path, rule,
  coalesce(rule_verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed
FROM judged
"""
