"""Records of delimited text whose quoted fields go on over several lines, over splits of files.

A line either leaves it as it was whether one is inside a quoted field, or it changes that.
A task reads its splits in order, so it knows what a whole split does to that state; the
effects of splits are put in order within their file, and give the state that each begins
in. With it, a second look puts the lines of a record together where they stand. Only the
lines of records that go over the end of a split are moved.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywell.session import materialize

#: Lines of the longest record. An opening quote whose end is further away, or that never
#: ends, is an ordinary sign, and the lines behind it stand alone.
MOST_LINES = 10_000

#: What is known of a part of a record that lies in one split: it goes on from the split
#: before, it goes on in the next one, or both.
FROM_BEFORE, GOES_ON = 1, 2


def _stays_open(part: Column) -> Column:
    """Whether a quoted field goes on behind a text in it: no single quote ends it."""
    return ~F.contains(F.replace(part, F.lit('""'), F.lit("")), F.lit('"'))


def _inside_after(line: Column, delimiter: str, inside: bool) -> Column:
    """Whether one is inside a quoted field behind a line, by whether one was before it.

    A quote opens a field at its start only; one that stands twice is a sign of the field.
    """
    fields = F.split(line, F.lit("[" + ("\\t" if delimiter == "\t" else delimiter) + "]"))

    def step(state: Column, field: Column) -> Column:
        opens = F.startswith(field, F.lit('"')) & _stays_open(F.substring(field, 2, 2_147_483_647))
        return F.when(state, _stays_open(field)).otherwise(opens)

    return F.aggregate(fields, F.lit(inside), step)


def quoted_parts(line: Column) -> Column:
    """The text between the quotes of a line: one part without quotes, three with two, at most four are told apart."""
    return F.split(line, '"', 4)


def opens_field(line: str, delimiter: str, parts: Column | None = None) -> Column:
    """Whether a line that begins outside of quotes ends inside; without such lines no record is longer than a line.

    No field opens without a quote at its start, and none is open where all quotes belong to
    whole fields without a quote in them; only other lines are walked field by field. Lines
    of two quotes, the usual ones, are known by the text beside the quotes, however long it is;
    ``parts`` are its ``quoted_parts``, for callers that have them in a column.
    """
    value, mark = F.col(line), F.lit(delimiter)
    starts = F.startswith(value, F.lit('"')) | F.contains(value, F.lit(f'{delimiter}"'))
    sign = re.escape(delimiter)
    others = F.regexp_replace(value, f'"(?<![^{sign}]")[^"]*+"(?![^{sign}])', "")
    walked = starts & F.contains(others, F.lit('"')) & _inside_after(value, delimiter, False)
    parts = quoted_parts(value) if parts is None else parts
    first, middle, last = (F.get(parts, F.lit(k)) for k in range(3))
    at_start = (first == "") | F.endswith(first, mark)
    whole = at_start & ((last == "") | F.startswith(last, mark))
    of_two = ~whole & (at_start | F.endswith(middle, mark)) & _inside_after(value, delimiter, False)
    return F.when(F.size(parts) == 1, False).when(F.size(parts) == 3, of_two).otherwise(walked)


def _with_states(lines: DataFrame, delimiter: str) -> DataFrame:
    """Add ``key`` of the file, and ``from_out`` and ``from_in``: the state behind a line by the one before it."""
    value = F.col("value")
    from_in = F.when(F.contains(value, F.lit('"')), _inside_after(value, delimiter, True)).otherwise(True)
    return lines.withColumns({"key": F.xxhash64("file"), "from_out": opens_field("value", delimiter), "from_in": from_in})


def _state_before(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``before``: the state ahead of each row of ``keys``, from outside at the first; rows have ``from_out`` and ``from_in``.

    A row sets the state, turns it or leaves it. The state is what was set last, turned as
    often as it has been turned since.
    """
    earlier = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    turns = F.when(~F.col("from_in") & F.col("from_out"), 1).otherwise(0)
    counted = rows.withColumn("turned", F.coalesce(F.sum(turns).over(earlier), F.lit(0)))
    sets = F.when(F.col("from_in") == F.col("from_out"), F.struct(F.col("from_in").alias("state"), F.col("turned").alias("at")))
    last = F.last(sets, ignorenulls=True).over(earlier)
    base, since = F.coalesce(last["state"], F.lit(False)), F.col("turned") - F.coalesce(last["at"], F.lit(0))
    return counted.withColumn("before", base != (since % 2 == 1)).drop("turned")


def splits_of(lines: DataFrame, delimiter: str) -> DataFrame:
    """``key, file, split, from_out, from_in, filled`` of every split, written once.

    ``from_out`` and ``from_in`` are what all its lines do together, ``filled`` is the number
    in the split of its first line that isn't blank. ``lines`` has ``file, split, value`` in
    the order of the text.
    """

    def effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "file", "split", "from_out", "from_in", "filled"]
        types = [pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64()]
        now, seen = None, 0
        for batch in batches:
            key, split, out, ins, full = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "split", "from_out", "from_in", "full"))
            borders = np.flatnonzero((key[1:] != key[:-1]) | (split[1:] != split[:-1])) + 1
            done = []
            for a, b in zip([0, *borders], [*borders, len(key)]):
                if b == a:
                    continue
                if now is None or (now["key"], now["split"]) != (key[a], split[a]):
                    done += [now] if now else []
                    now, seen = {"key": key[a], "file": batch.column("file")[int(a)].as_py(), "split": split[a], "from_out": False, "from_in": True, "filled": None}, 0
                sets, turns = np.flatnonzero(out[a:b] == ins[a:b]), out[a:b] & ~ins[a:b]
                if len(sets):
                    now["from_out"] = now["from_in"] = bool(out[a + sets[-1]]) ^ bool(turns[sets[-1] :].sum() % 2)
                elif turns.sum() % 2:
                    now["from_out"], now["from_in"] = not now["from_out"], not now["from_in"]
                if now["filled"] is None and full[a:b].any():
                    now["filled"] = seen + int(full[a:b].argmax())
                seen += int(b - a)
            yield pa.RecordBatch.from_arrays([pa.array([d[n] for d in done], t) for n, t in zip(names, types)], names)
        last = [now] if now else []
        yield pa.RecordBatch.from_arrays([pa.array([d[n] for d in last], t) for n, t in zip(names, types)], names)

    narrow = _with_states(lines, delimiter).select("key", "file", "split", "from_out", "from_in", (F.trim("value") != "").alias("full"))
    return materialize(narrow.mapInArrow(effects, "key long, file string, split long, from_out boolean, from_in boolean, filled long"), "splits")


def _pieces(lines: DataFrame, splits: DataFrame, delimiter: str, most_lines: int) -> DataFrame:
    """``key, split, row, value, part, lines``: the records of each split, and the lines of parts of others.

    ``row`` counts the lines of the split and ``part`` is null for what is a record. A part
    that is too long by itself gives its lines as records and one row without a value, which
    says how many they are.
    """
    begins = _state_before(splits.withColumnsRenamed({"key": "of"}), ["of"], ["split"]).where("before AND split > 0")
    begins = begins.select("of", F.col("split").alias("at"), F.lit(True).alias("begins"))
    names = ["key", "split", "row", "value", "part", "lines"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, state, count = None, False, 0  # Of the line before: key and split, the state behind it, its number.
        held = None  # Lines of a record that is open where the batch before ends.
        over = None  # Key, split, first number, part and lines of an open record with too many lines, which are given already.

        def table(*columns) -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64()]
            arrays = [c.cast(t) if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)]
            return pa.RecordBatch.from_arrays(arrays, names)

        def alone(key, split, row, value) -> pa.RecordBatch:
            return table(key, split, row, value, pa.nulls(len(row), pa.int32()), np.ones(len(row), np.int64))

        def marker(part: tuple[int, int, int, int, int]) -> pa.RecordBatch:
            return table([part[0]], [part[1]], [part[2]], pa.nulls(1, pa.string()), [part[3]], [part[4]])

        def given(key, split, row, value, start, before, after) -> Iterator[pa.RecordBatch]:
            """What whole groups of lines give; a group begins at each ``start``."""
            first = np.flatnonzero(start)
            size = np.diff(np.append(first, len(start)))
            part = np.where(before[first], FROM, 0) + np.where(after[first + size - 1], ON, 0)
            long = size > most_lines
            apart = np.repeat(long | (part > 0), size)
            begin = np.flatnonzero(start | apart)
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(begin, len(start)), pa.int32()), value), "\n")
            shown = np.repeat(np.where(long, 0, part), size)[begin]
            yield table(key[begin], split[begin], row[begin], texts, pa.array(shown, pa.int32(), mask=shown == 0), np.ones(len(begin), np.int64))
            for g in np.flatnonzero(long & (part > 0)):
                yield marker((key[first[g]], split[first[g]], row[first[g]], part[g], size[g]))

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            key, split, out, ins, begin = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "split", "from_out", "from_in", "begins"))
            value = batch.column("value")
            new = np.ones(n, bool)
            new[1:] = (key[1:] != key[:-1]) | (split[1:] != split[:-1])
            new[0] = place != (key[0], split[0])
            # The state ahead of the first line of a split or a batch is known, so that line sets it.
            known = new.copy()
            known[0] = True
            ahead = np.where(new, begin, state)
            sets, turns = known | (out == ins), out & ~ins & ~known
            value_set = np.where(known, np.where(ahead, ins, out), out)
            at, turned = np.maximum.accumulate(np.where(sets, np.arange(n), 0)), np.cumsum(turns)
            after = value_set[at] ^ ((turned - turned[at]) % 2 == 1)
            before = np.where(known, ahead, np.append(False, after[:-1]))
            reset = np.maximum.accumulate(np.where(known, np.arange(n), 0))
            row = np.arange(n) - reset + np.where(new, 0, count + 1)[reset]
            place, state, count = (key[-1], split[-1]), bool(after[-1]), int(row[-1])
            start = new | ~before
            if over and new[0]:
                yield marker((*over[:3], over[3] | ON, over[4]))
                over = None
            if over:
                most = int(start.argmax()) if start.any() else n
                yield alone(key[:most], split[:most], row[:most], value[:most])
                over = (*over[:4], over[4] + most)
                if after[most - 1] and most == n:
                    continue
                if over[3] or after[most - 1]:
                    yield marker((*over[:3], over[3] | (ON if after[most - 1] else 0), over[4]))
                over = None
                key, split, row, value, start, before, after = (x[most:] for x in (key, split, row, value, start, before, after))
            if held:
                joined = [np.concatenate(pair) for pair in zip(held[:3], (key, split, row))]
                flags = [np.concatenate(pair) for pair in zip(held[4:], (start, before, after))]
                (key, split, row), value, (start, before, after) = joined, pa.concat_arrays([held[3], value]), flags
                held = None
            whole = len(start)
            if whole and after[-1]:
                whole = int(np.flatnonzero(start)[-1])
                rest = tuple(x[whole:] for x in (key, split, row, value, start, before, after))
                if len(rest[0]) > most_lines:
                    yield alone(*rest[:4])
                    over = (rest[0][0], rest[1][0], rest[2][0], FROM if rest[5][0] else 0, len(rest[0]))
                else:
                    held = rest
            if whole:
                yield from given(*(x[:whole] for x in (key, split, row, value, start, before, after)))
        if held:
            yield from given(*held)
        if over:
            yield marker((*over[:3], over[3] | ON, over[4]))

    FROM, ON = FROM_BEFORE, GOES_ON
    # Only splits behind the first of a file can begin inside quotes, so this is less than a row per split; a join by sorting would lose the order.
    known = _with_states(lines, delimiter).join(F.broadcast(begins), (F.col("key") == F.col("of")) & (F.col("split") == F.col("at")), "left")
    given = known.select("key", "split", "value", "from_out", "from_in", F.coalesce("begins", F.lit(False)).alias("begins"))
    return materialize(given.mapInArrow(cut, "key long, split long, row long, value string, part int, lines long"), "pieces")


def records(lines: DataFrame, splits: DataFrame, delimiter: str, most_lines: int = MOST_LINES) -> DataFrame:
    """``key, split, row, value``: one row per record, lines of a quoted field joined by line feeds.

    ``splits`` are those of ``splits_of``. ``split`` and ``row`` are those of the first line.
    Parts of records are put in order by file, one row each; a record whose parts have too
    many lines together, or that no line closes, is its lines.
    """
    pieces = _pieces(lines, splits, delimiter, most_lines)
    apart = pieces.where("part IS NOT NULL")
    parts = apart.groupBy("key", "split", "part").agg(F.sum("lines").alias("lines"))
    so_far = Window.partitionBy("key").orderBy("split", "part")
    parts = parts.withColumn("number", F.count_if(F.col("part") == GOES_ON).over(so_far))
    together = Window.partitionBy("key", "number")
    closed = F.bool_or(F.col("part") == FROM_BEFORE).over(together)
    parts = parts.select("key", "split", "part", "number", (closed & (F.sum("lines").over(together) <= most_lines)).alias("whole"))
    placed = apart.drop("lines").join(parts, ["key", "split", "part"])
    found = placed.where("whole").groupBy("key", "number").agg(F.array_sort(F.collect_list(F.struct("split", "row", "value"))).alias("parts"))
    found = found.select("key", F.col("parts")[0]["split"].alias("split"), F.col("parts")[0]["row"].alias("row"), F.array_join("parts.value", "\n").alias("value"))
    columns = ["key", "split", "row", "value"]
    single = placed.where("NOT whole AND value IS NOT NULL").select(*columns)
    return pieces.where("part IS NULL").select(*columns).unionByName(single).unionByName(found)
