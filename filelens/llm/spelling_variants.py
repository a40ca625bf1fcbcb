"""Spelling variants of the words of all documents, found in a trie of letter-group counts.

A word's path holds its letters counted by group (code point modulo
``len(LEVELS)``, the frequent groups first).  One inserted letter raises one
count by one, one deleted letter lowers one, one replaced letter does both or
neither.  The words lie in a trie whose levels are the successive counts; a
depth-first search for a word's neighbours follows its own counts and may spend
a surplus of one and, after it, a deficit of one on its way; a neighbour that is
reached by a deficit first reaches this word by a surplus first, so each pair is
met once and told to both.  A node of few words is a leaf; its words are
verified letter by letter.  A task searches for many words at once: a step of
the search moves all words that spent the same in the same places.

The trie is cut at a depth at which no subtree holds more than ``SUBTREE``
words (measured); a subtree is the unit of work of a task.  A word's search
enters every subtree that its budget reaches: at most ``1 + d * (d + 1) / 2``
at depth ``d``.  Words of one beginning beyond ``SUBTREE`` at the last depth are
dealt to several subtrees, each of which is searched, so a task's memory is
bounded at any vocabulary and no link is lost.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filelens.llm import common as C
from filelens.session import default_parallelism

#: Letter groups in the order of the trie's levels: e u, a q, i y, n, c s, b r, d t, l, o, m, ...
LEVELS = (5, 1, 9, 14, 3, 2, 4, 12, 15, 13, 0, 8, 7, 6, 10, 11)
#: Levels that a cut may lie below, and the bits of a count in a subtree's key.
CUT_LEVELS, KEY_BITS = 6, 10
#: Words of one subtree at most.
SUBTREE = 20_000
#: Words of the vocabulary that one task of the search takes, on average.
WORDS_A_TASK = 20_000
#: Words searched for at once, and candidate pairs verified at once.
ASKED_AT_ONCE, PAIRS_AT_ONCE = 20_000, 200_000
#: A node with so many words or fewer is not divided further.
LEAF = 4
#: Entries of a level's table of children; a level with greater counts is searched by bisection.
TABLE = 1 << 22
#: Letters up to which words are compared as rows of a matrix; longer ones are compared one by one.
WIDTH = 32
#: Distinct words that a task counts before it hands them on.
WORDS_AT_ONCE = 200_000
MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
#: Every so manieth occurrence (by hash) loses a letter.
EDIT_EVERY = 31

# The letters of a word (all in Latin-1), and those that are lower-cased.
LETTERS = frozenset([*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)])
#: Latin-1 bytes: A-Z lower-cased, anything but letters a space (so is what Latin-1 lacks).
_FOLDED = bytes((c + 32 if c < 91 else c) if c in LETTERS else 32 for c in range(256))


def words_of(doc_id: int | None, text: str, min_length: int, every: int) -> list[bytes]:
    """The words of a text, in Latin-1: maximal runs of letters, A-Z lower-cased;
    a run whose hash ``every`` divides lacks one letter.  Runs shorter than
    ``min_length`` are left out, as no run grows."""
    head = zlib.crc32(b"%d:" % doc_id if doc_id is not None else b":")
    found = [w for w in text.encode("latin-1", "replace").translate(_FOLDED).split() if len(w) >= min_length]
    for k, word in enumerate(found):
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), head)
        if h % every == 0:
            at = h % len(word)
            found[k] = word[:at] + word[at + 1 :]
    return found


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, every: int = EDIT_EVERY) -> DataFrame:
    """``word, n`` of the words of ``doc_id, text`` with ``min_length`` letters
    or more that occur ``min_count`` times or more over all documents.

    A null text has no words; a null id counts as an empty one in the hash;
    every row counts, repeated ones too.  A task adds up its words before the
    shuffle, so a common word is a few rows, not its occurrences.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in seen], pa.string()), pa.array(list(seen.values()), pa.int64())],
                                              names=["word", "n"])

        for piece in C.slices(batches, "text"):
            for doc_id, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist(), strict=True):
                seen.update(words_of(doc_id, text, min_length, every))
            if len(seen) > WORDS_AT_ONCE:
                yield out()
                seen.clear()
        yield out()

    C.ready(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), C.text_or_empty().alias("text"))
    counted = rows.mapInArrow(count, "word string, n bigint").where(F.char_length("word") >= min_length)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


_LEVEL_OF = np.array([LEVELS.index(c % len(LEVELS)) for c in range(256)])


class Words:
    """Words as numbers: ``paths`` (letters by level), ``lengths``, and ``letters``
    (a row of ``WIDTH`` code points each, longer words cut: those are compared as text)."""

    def __init__(self, words: list[str]):
        self.words = words
        letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        row = np.repeat(np.arange(len(words)), self.lengths)
        self.paths = np.bincount(row * len(LEVELS) + _LEVEL_OF[letters], minlength=len(words) * len(LEVELS)).reshape(-1, len(LEVELS))
        place = np.arange(len(letters)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        kept = place < WIDTH
        self.letters = np.zeros((len(words), WIDTH), np.uint8)
        self.letters[row[kept], place[kept]] = letters[kept]


def subtree_keys(digits: np.ndarray) -> np.ndarray:
    """The first counts of paths as one number each; great counts look alike."""
    digits, key = np.minimum(digits, (1 << KEY_BITS) - 1), np.zeros(len(digits), np.int64)
    for level in range(digits.shape[1]):
        key = key << KEY_BITS | digits[:, level]
    return key


def reachable(digits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``row, key`` of the beginnings of a path that a search for a word of
    these first counts may take: as they are, a surplus of one, or a surplus of
    one and behind it a deficit of one."""
    n, depth = digits.shape
    rows, keys = [np.arange(n)], [subtree_keys(digits)]
    for more in range(depth):
        for less in [None, *range(more + 1, depth)]:
            moved = digits.copy()
            moved[:, more] += 1
            if less is not None:
                moved[:, less] -= 1
            ok = np.flatnonzero((moved >= 0).all(1))
            rows.append(ok)
            keys.append(subtree_keys(moved[ok]))
    row, key = np.concatenate(rows), np.concatenate(keys)
    alike = (digits >= (1 << KEY_BITS) - 1).any(1)[row]  # a key may not show a change of a great count
    if alike.any():
        own = np.unique(np.stack([row[alike], key[alike]]), axis=1)
        row, key = np.concatenate([row[~alike], own[0]]), np.concatenate([key[~alike], own[1]])
    return row, key


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one letter is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def verified(left: Words, i: np.ndarray, right: Words, j: np.ndarray) -> np.ndarray:
    """For each pair of places whether the words are exactly one edit apart."""
    apart = right.lengths[j] - left.lengths[i]
    out = np.zeros(len(i), bool)
    narrow = np.maximum(left.lengths[i], right.lengths[j]) <= WIDTH
    for at in np.flatnonzero(~narrow & (np.abs(apart) <= 1)):
        out[at] = one_edit(left.words[i[at]], right.words[j[at]])
    same = np.flatnonzero(narrow & (apart == 0))
    out[same] = (left.letters[i[same]] != right.letters[j[same]]).sum(1) == 1
    for step, short, p, long, q in ((1, left, i, right, j), (-1, right, j, left, i)):
        at = np.flatnonzero(narrow & (apart == step))
        a, b = short.letters[p[at]], long.letters[q[at]]
        before = np.logical_and.accumulate(a == b, axis=1)  # equal up to here
        moved = np.zeros_like(b)
        moved[:, :-1] = b[:, 1:]
        out[at] = (before | (a == moved)).all(1)
    return out


class Trie:
    """Words by their paths.  Nodes of a level are numbered in the order of
    their paths; ``levels[l]`` finds the child of a node by count."""

    def __init__(self, held: Words):
        self.held = held
        self.order = np.lexsort(held.paths.T[::-1])
        paths = held.paths[self.order]
        node = np.zeros(len(paths), np.int64)
        self.starts, self.levels = [np.array([0, len(paths)])], []
        for level in range(len(LEVELS)):
            base = int(paths[:, level].max(initial=0)) + 2
            keys = node * base + paths[:, level]
            first = np.ones(len(keys), bool)
            first[1:] = keys[1:] != keys[:-1]
            own = keys[first]
            table = None
            if (size := (len(self.starts[-1]) - 1) * base) <= TABLE:
                table = np.full(size, -1, np.int32)
                table[own] = np.arange(len(own))
            self.levels.append((base, own, table))
            node = np.cumsum(first) - 1
            self.starts.append(np.append(np.flatnonzero(first), len(keys)))

    def _child(self, level: int, node: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base, keys, table = self.levels[level]
        inside = np.flatnonzero((count >= 0) & (count < base))
        want = node[inside] * base + count[inside]
        if table is not None:
            at = table[want]
            found = at >= 0
        else:
            at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            found = keys[at] == want
        return inside[found], at[found].astype(np.int64)

    def near(self, asked: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of places, of a word asked for and of a held one that is one
        edit away, where the first count that differs is the held one's by one
        more, or none differs and the held one is the greater word."""
        n = len(asked.words)
        stack = [(0, np.arange(n), np.zeros(n, np.int64), True, True)] if self.held.words and n else []
        while stack:
            level, who, node, surplus, deficit = stack.pop()
            sizes = self.starts[level][node + 1] - self.starts[level][node]
            small = sizes <= LEAF if level < len(LEVELS) else np.ones(len(who), bool)
            if small.any():
                for i, j in self._leaves(asked, who[small], self.starts[level][node[small]], sizes[small]):
                    if surplus:
                        apart = self.held.paths[j] - asked.paths[i]
                        sign = apart[np.arange(len(i)), (apart != 0).argmax(1)]
                        later = np.array([asked.words[a] < self.held.words[b] for a, b in zip(i, j, strict=True)], bool)
                        keep = (sign > 0) | (sign == 0) & later
                        i, j = i[keep], j[keep]
                    yield i, j
                who, node = who[~small], node[~small]
            if not len(who):
                continue
            own = asked.paths[who, level]
            for spent in (0, 1) if surplus else (0, -1) if deficit else (0,):
                found, child = self._child(level, node, own + spent)
                if len(found):
                    stack.append((level + 1, who[found], child, surplus and not spent, deficit and spent != -1))

    def _leaves(self, asked: Words, who: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The pairs of each word and the words of its leaf that are one edit apart."""
        bounds = np.cumsum(sizes)
        at = 0
        while at < len(who):  # a bounded number of pairs at once, one word's leaf at least
            stop = max(at + 1, int(np.searchsorted(bounds, (bounds[at - 1] if at else 0) + PAIRS_AT_ONCE, "right")))
            n = sizes[at:stop]
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            i, j = np.repeat(who[at:stop], n), self.order[np.repeat(starts[at:stop], n) + inside]
            hit = verified(asked, i, self.held, j)
            yield i[hit], j[hit]
            at = stop


_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best", pa.string()), ("best_n", pa.int64())])


def _best(words: list[str], i: np.ndarray, others: list[str], counts: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    """``word, n_near, best, best_n`` of the words at ``i``, whose neighbours are the others at ``j``."""
    rank = np.empty(len(others), np.int64)
    used = np.unique(j)
    rank[sorted(used.tolist(), key=others.__getitem__)] = np.arange(len(used))
    order = np.lexsort((rank[j], -counts[j], i))
    who, first, n = np.unique(i[order], return_index=True, return_counts=True)
    best = j[order][first]
    return pa.RecordBatch.from_arrays([pa.array([words[k] for k in who], pa.string()), pa.array(n, pa.int64()),
                                       pa.array([others[k] for k in best], pa.string()), pa.array(counts[best], pa.int64())], schema=_FOUND)


def neighbours(trie: Trie, counts: np.ndarray, asked: list[str], asked_counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``word, n_near, best, best_n`` of the words asked for and of the held ones,
    as far as the pairs between them go."""
    pairs = list(trie.near(Words(asked)))
    if pairs:
        i, j = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
        yield _best(asked, i, trie.held.words, counts, j)
        yield _best(trie.held.words, j, asked, asked_counts, i)


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``key, part, asks, word, n`` sorted by the first three: each
    subtree's words, then the words that are searched for in it."""
    at, held, counts, trie, asked, asked_counts = None, [], [], None, [], []

    def found() -> Iterator[pa.RecordBatch]:
        if asked:
            yield from neighbours(trie, np.array(counts), asked, np.array(asked_counts))

    for batch in batches:
        keys, parts, asks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "part", "asks"))
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (parts[1:] != parts[:-1]) | (asks[1:] != asks[:-1])
        bounds = [*np.flatnonzero(new).tolist(), len(keys)]
        for start, stop in zip(bounds, bounds[1:], strict=False):
            if (keys[start], parts[start]) != at:
                yield from found()
                at, held, counts, trie, asked, asked_counts = (keys[start], parts[start]), [], [], None, [], []
            words, ns = (batch.column(c).slice(start, stop - start).to_pylist() for c in ("word", "n"))
            if not asks[start]:
                held += words
                counts += ns
                continue
            trie = trie or Trie(Words(held))
            asked += words
            asked_counts += ns
            if len(asked) >= ASKED_AT_ONCE:  # a batch of Arrow's more at most
                yield from found()
                asked, asked_counts = [], []
    yield from found()


def _depth(sizes: DataFrame) -> int:
    """The least depth at which no subtree holds more than ``SUBTREE`` words, or the last one."""
    depths = F.sequence(F.lit(0), F.lit(CUT_LEVELS))
    heads = sizes.select(F.explode(F.transform(depths, lambda d: F.struct(
        d.alias("depth"), F.call_function("shiftright", F.col("key"), KEY_BITS * (CUT_LEVELS - d)).alias("head")))).alias("x"), "n")
    most = heads.groupBy("x.depth", "x.head").agg(F.sum("n").alias("n")).groupBy("depth").agg(F.max("n").alias("n"))
    most = {r.depth: r.n for r in most.collect()}  # CUT_LEVELS + 1 numbers
    return next((d for d in range(CUT_LEVELS + 1) if most.get(d, 0) <= SUBTREE), CUT_LEVELS)


def near_words(counts: DataFrame) -> DataFrame:
    """``word, n, n_near, best, best_n`` of every row of ``word, n`` (distinct
    words): how many words are one edit away, and the most frequent of them
    (ties: the smallest); nulls where there is none."""
    spark = counts.sparkSession
    C.ready(spark)

    def with_key(batch: pa.RecordBatch) -> pa.RecordBatch:
        key = subtree_keys(Words(batch.column("word").to_pylist()).paths[:, :CUT_LEVELS])
        return pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(key, pa.int64())], names=["word", "n", "key"])

    words = C.stored(counts.select("word", "n").mapInArrow(lambda bs: map(with_key, bs), "word string, n bigint, key bigint"), "words")
    sizes = C.stored(words.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "sizes")
    depth = _depth(sizes)
    head = F.shiftright("key", KEY_BITS * (CUT_LEVELS - depth))
    # the subtrees of the cut; one that no depth makes small enough is dealt to several
    cut = sizes.groupBy(head.alias("key")).agg(F.ceil(F.sum("n") / SUBTREE).cast("int").alias("parts"))
    held = words.select("word", "n", head.alias("key"))
    index = held.join(cut, "key").select("key", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int").alias("part"), F.lit(0).alias("asks"), "word", "n")

    def route(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, key = reachable(Words(batch.column("word").to_pylist()).paths[:, :depth])
        row = pa.array(row)
        return pa.RecordBatch.from_arrays([batch.column("word").take(row), batch.column("n").take(row), pa.array(key, pa.int64())], names=["word", "n", "key"])

    ways = words.select("word", "n").mapInArrow(lambda bs: map(route, bs), "word string, n bigint, key bigint")
    asked = ways.join(cut, "key").select("key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(1).alias("asks"), "word", "n")
    tasks = max(default_parallelism(spark), math.ceil(words.count() / WORDS_A_TASK))
    routed = index.unionByName(asked).repartition(tasks, "key", "part").sortWithinPartitions("key", "part", "asks")
    found = routed.mapInArrow(_searched, "word string, n_near bigint, best string, best_n bigint")
    first = F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best"))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(first).alias("first"))
    out = words.join(found, "word", "left")
    return out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.col("first.best").alias("best"), (-F.col("first.less")).alias("best_n"))


def with_roots(forms: DataFrame) -> DataFrame:
    """``forms`` (``word, form, ...``) with ``root``: where the forms lead.

    Every form is ``RATIO`` times as frequent as its word, so no way is longer
    than the digits of the greatest count; each round doubles the steps made.
    """
    step = C.stored(forms.select("word", F.coalesce("form", "word").alias("root")), "steps")
    longest = int(math.log(max(forms.agg(F.max("n")).first()[0] or 1, RATIO), RATIO)) + 1
    for _ in range(math.ceil(math.log2(longest)) + 1 if longest > 1 else 1):
        ahead = step.select(F.col("word").alias("at"), F.col("root").alias("further"))
        step = C.stored(step.join(ahead, step.root == ahead["at"]).select("word", F.col("further").alias("root")), "steps")
    return forms.join(step, "word")


def variant_groups(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO, every: int = EDIT_EVERY) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``docs``.

    ``form`` is the most frequent word one edit away, if ``ratio`` times as
    frequent (ties: the smallest in code-point order), else null with a null
    ``form_n``; ``root`` follows the forms to the last, and is the word itself
    without one.  Null and empty texts have no words, an empty table no rows;
    columns other than ``doc_id`` and ``text`` are not read.
    """
    counts = C.stored(word_counts(docs, min_length, min_count, every), "counts")
    near = near_words(counts)
    far = F.col("best_n") >= ratio * F.col("n")
    forms = C.stored(near.select("word", F.when(far, F.col("best")).alias("form"), "n", "n_near", F.when(far, F.col("best_n")).alias("form_n")), "forms")
    return with_roots(forms).select("word", "form", "root", "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variant groups of the words of all documents."""
    return variant_groups(C.table(spark, sf_dir, "documents"))


def _crc_table() -> list[int]:
    """What one byte does to a CRC-32 (reflected polynomial 0xEDB88320)."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


SQL = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
long AS (SELECT run, CAST(doc_id AS VARCHAR) || ':' || run AS tagged FROM runs WHERE length(run) >= {MIN_LENGTH}),
bytes AS (SELECT run, flatten(list_transform(string_split(tagged, ''),
            lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] ELSE [195::BIGINT, CAST(ord(c) - 64 AS BIGINT)] END)) AS bs FROM long),
crc AS (SELECT run, xor(list_reduce(list_prepend(4294967295::BIGINT, bs),
            lambda h, b: xor(h >> 8, CAST(({_crc_table()})[xor(h & 255, b) + 1] AS BIGINT))), 4294967295::BIGINT) AS h FROM bytes),
words AS (SELECT CASE WHEN h % {EDIT_EVERY} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM crc),
v AS (SELECT word, count(*) AS n FROM words WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING count(*) >= {MIN_COUNT}),
gaps AS (SELECT word, n, i, left(word, i - 1) AS a, substr(word, i + 1) AS b FROM v, unnest(range(1, length(word) + 1)) AS t(i)),
near AS (SELECT DISTINCT x.word, y.word AS other, y.n AS m FROM gaps x JOIN gaps y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
         UNION SELECT DISTINCT g.word, v.word, v.n FROM gaps g JOIN v ON v.word = g.a || g.b
         UNION SELECT DISTINCT v.word, g.word, g.n FROM gaps g JOIN v ON v.word = g.a || g.b),
best AS (SELECT word, count(*) AS n_near, max(m) AS m FROM near GROUP BY word),
forms AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.m >= {RATIO} * v.n THEN best.m END AS form_n,
            CASE WHEN best.m >= {RATIO} * v.n THEN (SELECT min(other) FROM near WHERE near.word = v.word AND near.m = best.m) END AS form
          FROM v LEFT JOIN best ON best.word = v.word),
ways AS (SELECT word, word AS at FROM forms UNION SELECT ways.word, forms.form FROM ways JOIN forms ON forms.word = ways.at WHERE forms.form IS NOT NULL),
roots AS (SELECT ways.word, ways.at AS root FROM ways JOIN forms ON forms.word = ways.at WHERE forms.form IS NULL)
SELECT forms.word, form, root, n, n_near, form_n FROM forms JOIN roots ON roots.word = forms.word
"""
