"""Spelling variants by finite-state composition: vocabulary acceptor o one-edit transducer o vocabulary acceptor.

Words. Maximal runs of letters of every whole text, ASCII capitals lowered, are counted by Spark (partial sums first, so
a word with a third of all occurrences is one row a task). Some occurrences lose a letter by a keyed rule, see ``words``.

Pairs. Two words are near if one insertion, deletion or replacement of a code point turns one into the other. If the
shorter has n code points, the two agree in their first n // 2 code points or in their last: the edit lies in one half
only. So the vocabulary is partitioned by (n, half): the words of n and n + 1 code points that agree in the first (or,
read backwards, the last) n // 2. That half leads every word of a partition to one state, the partition's initial
state; its acceptor is the rest of the words from there on. Per partition

* the acceptor is minimised: states with equal rests are one (hash-consed from the last letter back, in a register that
  both word lengths share);
* it is composed with the transducer, state by state: (p, e, q) with e = 0 before the edit, 1 after it. Before the edit
  both sides read the same letter; the edit replaces a letter by a larger one, or inserts one (not before its own
  equal: one path a pair); after it both sides read the same again, and states that meet twice are one;
* accepted pairs are read off backwards from the final states, so only states that reach one are walked.

Backward partitions skip the pairs that agree in the first half too, so every pair is found once. Pairs do not leave
their task: a word's partial count and best near word do.

Roots. Forms at least double in count, so chains are short; they are followed by pointer jumping, a join a round.

Cases. Null and empty texts have no words; repeated rows and copies count each; a null doc_id writes as nothing before
the colon. Words may be of any length (no recursion). No words: no rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm.common import id_text, prepare, written

LEAST_LENGTH = 5
LEAST_COUNT = 3
EVERY = 97
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BUCKET_WORDS = 40_000
END = 0  # the one final state


def words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, every: int = EVERY) -> DataFrame:
    """word, n: the runs of letters that are long and frequent enough.

    With h = crc32 of ``<doc_id>:<run>``: where ``every`` divides h, the run's code point h % length is deleted first.
    """
    # a shorter run can only get shorter
    runs = id_text(docs).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{least_length},}}"), 0)).alias("run"))
    low = runs.select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, cut).otherwise(F.col("run"))
    return (low.withColumn("h", h).select(word.alias("word")).where(F.length("word") >= least_length)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count))


class Acceptor:
    """A register of states, ``arcs[state] = {letter: state}``; equal states are one, whichever words made them."""

    def __init__(self):
        self.arcs, self.known = [{}], {(): END}

    def state(self, arcs: dict) -> int:
        key = tuple(arcs.items())
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = len(self.arcs)
            self.arcs.append(arcs)
        return found

    def add(self, rests: list[str]) -> int | None:
        """The minimised acceptor of sorted distinct words of one length; its initial state."""
        if not rests:
            return None
        length = len(rests[0])
        agree = [0] * len(rests)
        for i in range(1, len(rests)):
            a, b, k = rests[i - 1], rests[i], 0
            while a[k] == b[k]:
                k += 1
            agree[i] = k
        live = [(i, END) for i in range(len(rests))]  # the first word of each prefix and its state
        for depth in range(length - 1, -1, -1):
            above, arcs, first = [], {}, 0
            for i, state in live:
                if i and agree[i] < depth:
                    above.append((first, self.state(arcs)))
                    arcs, first = {}, i
                arcs[rests[i][depth]] = state
            above.append((first, self.state(arcs)))
            live = above
        return live[0][1]


def composed(acceptor: Acceptor, left: int, right: int | None, insert: bool):
    """The pairs (u, v), u from ``left`` and v from ``right``, that one edit joins: a replacement by a larger letter
    (left = right), or an inserted letter.

    The product is built forward, a letter at a time, keeping of each state the arcs that lead to it; a state (p, 1, q, x)
    with x not None has just inserted x and may not read it next.
    """
    arcs = acceptor.arcs
    start = (left, 0, right, None)
    into: dict = {start: []}
    level = [start]
    while level:
        after: dict = {}
        for state in level:
            p, edit, q, barred = state
            ours, theirs = arcs[p], arcs[q]
            if edit:
                if len(theirs) < len(ours):
                    steps = [((ours[c], 1, t, None), c, c) for c, t in theirs.items() if c in ours and c != barred]
                else:
                    steps = [((t, 1, theirs[c], None), c, c) for c, t in ours.items() if c in theirs and c != barred]
            elif insert:
                steps = [((p, 1, t, c), "", c) for c, t in theirs.items()]
                steps += [((t, 0, theirs[c], None), c, c) for c, t in ours.items() if c in theirs]
            else:
                steps = [((t, 0, t, None), c, c) for c, t in ours.items()]
                letters = list(ours.items())
                steps += [((s, 1, t, None), a, b) for i, (a, s) in enumerate(letters) for b, t in letters[i + 1:]]
            for to, a, b in steps:
                if to not in into and to not in after:
                    after[to] = []
                (into if to in into else after)[to].append((state, a, b))
        into.update(after)
        level = list(after)
    # a path from a final state back to the start is an accepted pair
    walk = [(state, None, None) for state in into if state[0] == END and state[2] == END and state[1]]
    while walk:
        state, u, v = walk.pop()
        if state == start:
            a, b = [], []
            while u is not None:
                a.append(u[0])
                u = u[1]
            while v is not None:
                b.append(v[0])
                v = v[1]
            yield "".join(a), "".join(b)
        else:
            walk += [(back, (a, u) if a else u, (b, v)) for back, a, b in into[state]]


def near_in(group: list[tuple[str, int]], length: int, backward: bool, tally: dict) -> None:
    """Count the near pairs of one partition into ``tally``: word -> [near words, -best count, best word]."""
    half = length // 2
    turn = (lambda w: w[::-1]) if backward else (lambda w: w)
    count = dict(group)
    head = turn(group[0][0])[:half]
    short = sorted(turn(w)[half:] for w, _ in group if len(w) == length)
    if not short:
        return
    long = sorted(turn(w)[half:] for w, _ in group if len(w) > length)
    acceptor = Acceptor()
    a, b = acceptor.add(short), acceptor.add(long)
    for other, insert in ((a, False), (b, True)):
        if other is None or (not insert and len(short) < 2):
            continue
        for u, v in composed(acceptor, a, other, insert):
            u, v = turn(head + u), turn(head + v)
            if backward and u[:half] == v[:half]:
                continue  # the forward partition has it
            for w, x in ((u, v), (v, u)):
                held = tally.setdefault(w, [0, 1, ""])
                held[0] += 1
                best = (-count[x], x)
                if best < (held[1], held[2]):
                    held[1:] = best


def near(vocabulary: DataFrame, least_length: int = LEAST_LENGTH, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """word, n, n_near, best_n, best: the number of near words and the one of largest count (ties: the smallest)."""
    rows = vocabulary.select("word", "n", F.length("word").alias("l"))
    roles = rows.withColumn("size", F.explode(F.array("l", F.col("l") - 1))).where(F.col("size") >= least_length)
    roles = roles.withColumn("backward", F.explode(F.array(F.lit(False), F.lit(True))))
    half = F.floor(F.col("size") / 2).cast("int")
    head = F.when(F.col("backward"), F.substring("word", F.col("l") - half + 1, half)).otherwise(F.substring("word", F.lit(1), half))
    key = F.xxhash64("size", "backward", head)
    buckets = max(1, -(-4 * vocabulary.count() // bucket_words))
    dealt = roles.select("word", "n", "size", "backward", key.alias("key"), F.pmod(key, F.lit(buckets)).cast("int").alias("bucket"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        tally: dict = {}
        parts: dict = {}
        for word, n, size, backward in zip(pdf["word"], pdf["n"], pdf["size"], pdf["backward"], strict=True):
            h = size // 2
            parts.setdefault((size, backward, word[len(word) - h:] if backward else word[:h]), []).append((word, n))
        for (size, backward, _), group in parts.items():
            if len(group) > 1:
                near_in(group, size, backward, tally)
        return pd.DataFrame([(w, c, -m, x) for w, (c, m, x) in tally.items()], columns=["word", "n_near", "best_n", "best"])

    found = dealt.drop("key").groupBy("bucket").applyInPandas(run, "word string, n_near long, best_n long, best string")
    none = F.lit(None)
    both = vocabulary.select("word", "n", F.lit(0).cast("long").alias("n_near"), none.cast("long").alias("best_n"),
                             none.cast("string").alias("best"))
    both = both.unionByName(found.select("word", none.cast("long").alias("n"), "n_near", "best_n", "best"))
    least = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("m"), "best"))).alias("b")
    return (both.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), least)
            .select("word", "n", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """word, root for every row of ``forms`` (word, form, no nulls): the end of each chain of forms."""
    links = written(forms.select("word", F.col("form").alias("root")), "spelling-links", "snappy")
    while True:
        ahead = links.select(F.col("word").alias("at"), F.col("root").alias("further"))
        step = links.join(ahead, F.col("root") == F.col("at"), "left")
        step = written(step.select("word", F.coalesce("further", "root").alias("root"),
                                   F.col("further").isNotNull().alias("moved")), "spelling-links", "snappy")
        links = step.select("word", "root")
        if not step.where("moved").limit(1).count():
            return links


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, every: int = EVERY,
             factor: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n: ``form`` is the near word of largest count, if that is ``factor`` times the
    word's own or more; ``root`` the last of the chain of forms (the word itself without one)."""
    vocabulary = written(words(docs, least_length, least_count, every), "spelling-words")
    held = near(vocabulary, least_length)
    has = F.col("best_n") >= factor * F.col("n")
    held = written(held.select("word", "n", "n_near", F.when(has, F.col("best")).alias("form"),
                               F.when(has, F.col("best_n")).alias("form_n")), "spelling-near")
    ends = roots(held.where("form is not null")).select(F.col("word").alias("at"), "root")
    return (held.join(ends, F.col("word") == F.col("at"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op13_composed_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


# crc32 is spelled out: a table of 256 entries made by the rule of its polynomial, and a fold over the bytes.
SQL = """WITH RECURSIVE steps(i, k, c) AS (
  SELECT i, 0, CAST(i AS BIGINT) FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  WHERE length(run) >= 5 GROUP BY doc_id, run),
hashed AS (
  SELECT run, n, xor(list_reduce(list_transform(range(0, octet_length(encode(s))),
             lambda i: CAST(('0x' || substr(hex(encode(s)), CAST(2 * i + 1 AS INTEGER), 2)) AS BIGINT)),
           lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8), CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) AS h
  FROM (SELECT run, n, doc_id || ':' || run AS s FROM runs), crc),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER))
                                         || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cuts AS (SELECT word, i, substr(word, 1, CAST(i AS INTEGER)) || substr(word, CAST(i AS INTEGER) + 2) AS cut
         FROM (SELECT word, unnest(range(0, length(word))) AS i FROM words)),
one AS (
  SELECT a.word AS x, b.word AS y FROM cuts a JOIN cuts b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
  UNION SELECT a.word, b.word FROM cuts a JOIN words b ON a.cut = b.word
  UNION SELECT b.word, a.word FROM cuts a JOIN words b ON a.cut = b.word),
best AS (
  SELECT x, count(*) AS n_near, max(n) AS best_n FROM one JOIN words ON y = word GROUP BY x),
formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.best_n >= 2 * w.n THEN b.best_n END AS form_n,
         CASE WHEN b.best_n >= 2 * w.n THEN (
           SELECT min(y) FROM one JOIN words v ON y = v.word WHERE one.x = w.word AND v.n = b.best_n) END AS form
  FROM words w LEFT JOIN best b ON b.x = w.word),
chain(word, tip) AS (
  SELECT word, word FROM formed
  UNION ALL
  SELECT chain.word, form FROM chain JOIN formed ON chain.tip = formed.word WHERE form IS NOT NULL)
SELECT f.word, f.form, c.tip AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c ON c.word = f.word JOIN formed e ON e.word = c.tip WHERE e.form IS NULL"""
