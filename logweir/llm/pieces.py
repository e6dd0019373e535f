"""Piece encoding by sampling: forward filtering and backward sampling over the lattice of pieces.

A path's weight is exp(alpha * sum of the pieces' scores). The words of many texts are worked on together: their
distinct words make one lattice in flat arrays, filtered forward position by position, and all their occurrences
are sampled backward at once. A draw depends on the row's key, the word's number in the text and the step alone,
so a row is cut the same way in any batch, task, order or retry. A character without a piece, and the piece mark
itself, are written as bytes, so decoding gives back every text. Null texts give null; the empty text gives no
pieces; a null key seeds like the empty key, and equal rows are cut alike. Decoding leaves out control ids.
"""

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Weight of a score; the scores of a merge vocabulary are negative ranks, so differences are large.
ALPHA = 0.0005
#: No piece reaches over these cuts, so the lattice falls apart there without loss.
CHUNK = re.compile(r" *[^ \n]+| +|\n")
#: Characters of words worked on together, and ids decoded together; they bound the memory, not the result.
TOGETHER, DECODED = 250_000, 200_000
#: Bytes of the rows that are handed on together, unless one row has more.
HANDED = 1 << 20
STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x):
    """A bijective scramble of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def ranges(starts, sizes):
    """The numbers start, start + 1, ... of each range, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def words_of(text):
    """The words of a text in lists of some TOGETHER characters, so a long text is not cut all at once."""
    if len(text) <= TOGETHER:
        yield CHUNK.findall(text)
        return
    words, held = [], 0
    for found in CHUNK.finditer(text):
        words.append(found.group())
        held += len(words[-1])
        if held >= TOGETHER:
            yield words
            words, held = [], 0
    if words:
        yield words


class Vocabulary:
    def __init__(self, model, alpha=ALPHA):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        size = sp.get_piece_size()
        self.weight, self.ids, self.byte, raw = {}, {}, np.zeros(256, dtype=np.int32), [b""] * size
        lowest = 0.0
        for i in range(size):
            piece, score = sp.id_to_piece(i), sp.get_score(i)
            if sp.is_byte(i):
                self.byte[int(piece[3:-1], 16)] = i
                raw[i] = bytes([int(piece[3:-1], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                plain = piece.replace(MARK, " ")
                # A piece that crosses a cut cannot be sampled, but can be decoded.
                raw[i] = plain.encode()
                if "\n" not in plain and " " not in plain.lstrip(" "):
                    self.ids[plain], self.weight[plain] = i, alpha * score
                lowest = min(lowest, alpha * score)
        self.fallback, self.size = lowest - 1.0, size
        self.raw = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.raw_size = np.array([len(r) for r in raw])
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size
        self.grow()

    def grow(self):
        """The pieces as a tree of characters; a branch is found by its parent's number and its character."""
        branches, found = {}, {0: (-1, 0.0)}
        for plain, i in self.ids.items():
            at = 0
            for c in plain:
                at = branches.setdefault(at << 21 | ord(c), len(branches) + 1)
            found[at] = (i, self.weight[plain])
        keys = np.array(list(branches), dtype=np.int64)
        parents, letters = keys >> 21, keys & (1 << 21) - 1
        # Branches that go on have the lower numbers, so tables of what follows end with them.
        inner = np.zeros(len(keys) + 1, dtype=bool)
        inner[0] = inner[parents] = True
        number = np.empty(len(inner), dtype=np.int64)
        number[np.argsort(~inner, kind="stable")] = np.arange(len(inner))
        self.inner, keys = int(inner.sum()), number[parents] << 21 | letters
        order = np.argsort(keys)
        self.branch, self.child = keys[order], number[order + 1].astype(np.int32)
        # The branches of the first 128 characters are also a table, which spares a search.
        plain = np.flatnonzero(letters < 128)
        self.table = np.zeros(self.inner * 128, dtype=np.int32)
        self.table[number[parents[plain]] * 128 + letters[plain]] = number[plain + 1]
        self.piece, self.score = np.full(len(inner), -1, dtype=np.int32), np.zeros(len(inner))
        for at, (i, w) in found.items():
            self.piece[number[at]], self.score[number[at]] = i, w

    def arcs(self, codes, left):
        """(length, starts, symbols, weights) of the pieces found in a run of characters, shortest first.

        `left` is how many characters of its word lie at and behind each place. A character without a piece has
        a symbol of its own beyond the pieces; those characters are returned as well.
        """
        at, tree, out, length = np.arange(len(codes), dtype=np.int32), np.zeros(len(codes), dtype=np.int32), [], 0
        strange = np.zeros(0, dtype=np.uint32)
        while len(at):
            code = codes[at + length].astype(np.int32)
            far = np.flatnonzero(code > 127)
            asked = tree[far].astype(np.int64) << 21 | code[far]
            place = np.minimum(np.searchsorted(self.branch, asked), len(self.branch) - 1)
            tree = self.table[tree * 128 + (code & 127)]
            tree[far] = np.where(self.branch[place] == asked, self.child[place], 0)
            length += 1
            piece = self.piece[tree]
            if length == 1:
                lone = np.flatnonzero(piece < 0)
                strange, number = np.unique(codes[lone], return_inverse=True)
                bytes_of = 1 + (codes[lone] > 0x7F) + (codes[lone] > 0x7FF) + (codes[lone] > 0xFFFF)
                symbols, weights = piece.copy(), self.score[tree]
                symbols[lone], weights[lone] = self.size + number, self.fallback * bytes_of
                out.append((1, at, symbols, weights))
            else:
                hit = piece >= 0
                out.append((length, at[hit], piece[hit], self.score[tree[hit]]))
            on = (tree > 0) & (tree < self.inner) & (left[at] > length)
            at, tree = at[on], tree[on]
        return out, strange

    def lattice(self, words):
        """The lattice of distinct words: each word's last node, the bounds of the arcs, each node's last arc, the arcs' sources and symbols.

        Nodes are numbered by place in the word, then by word from the longest on, so the nodes of a place and the
        arcs that end there follow one another. An arc's share of its node is kept as node * 2**32 + the running
        sum of shares * 2**32, so an arc's lower bound is the upper one of the arc before it, also across nodes.
        """
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        order = np.argsort(-lengths, kind="stable")
        rank = np.empty(len(words), dtype=np.int64)
        rank[order] = np.arange(len(words))
        sizes = lengths[order]
        codes = np.frombuffer("".join([words[i] for i in order]).encode("utf-32-le"), dtype=np.uint32)
        holding = np.cumsum(np.bincount(sizes)[::-1])[::-1]
        layer = np.r_[0, np.cumsum(holding)]
        word, place = np.repeat(np.arange(len(words), dtype=np.int32), sizes), ranges(np.zeros(len(words), dtype=np.int64), sizes)
        found, strange = self.arcs(codes, sizes[word] - place)
        del codes
        ends = [layer[place[at] + length] + word[at] for length, at, _, _ in found]
        degree = sum(np.bincount(end, minlength=layer[-1]) for end in ends)
        first = np.r_[0, np.cumsum(degree)]
        used = first[1:].copy()
        source, symbol, weight = np.zeros(first[-1], dtype=np.int32), np.zeros(first[-1], dtype=np.int32), np.zeros(first[-1])
        while found:
            (_, at, symbols, weights), end = found.pop(), ends.pop()
            # The arcs of a node lie in order of their length, so the longest takes the last place left.
            used[end] -= 1
            to = used[end]
            source[to], symbol[to], weight[to] = layer[place[at]] + word[at], symbols, weights
        forward, share = np.zeros(layer[-1]), np.zeros(first[-1])
        for p in range(1, len(layer) - 1):
            begin, end = layer[p], layer[p + 1]
            low, high = first[begin], first[end]
            heads = first[begin:end] - low
            logs = forward[source[low:high]] + weight[low:high]
            top = np.maximum.reduceat(logs, heads)
            share[low:high] = np.exp(logs - np.repeat(top, degree[begin:end]))
            forward[begin:end] = top + np.log(np.add.reduceat(share[low:high], heads))
        # Running sums within a node do not depend on the other words, so neither does the arc drawn.
        open_nodes = np.flatnonzero(degree > 1)
        for j in range(1, degree.max()):
            open_nodes = open_nodes[degree[open_nodes] > j]
            to = first[open_nodes] + j
            share[to] += share[to - 1]
        node = np.repeat(np.arange(len(degree)), degree)
        last = first[1:] - 1
        bound = np.floor(share / share[last[node]] * 2.0**32).astype(np.int64)
        bound[last[degree > 0]] = 1 << 32
        return layer[lengths] + rank, np.r_[0, (node << 32) + bound], last, source, symbol, strange

    def drawn(self, words, which, seeds):
        """(ids, count of ids per occurrence) of one sampled path for each occurrence of a word."""
        final, lower, last, source, symbol, strange = self.lattice(words)
        node, live, state = final[which], np.arange(len(which)), seeds
        counts, steps = np.zeros(len(which), dtype=np.int64), []
        while len(live):
            with np.errstate(over="ignore"):
                state = state + STEP
            draw = (node << 32) + (mixed(state) >> np.uint64(32)).astype(np.int64)
            # The longest piece is the likeliest, so the arcs are tried from the last one down.
            arc = last[node]
            above = np.flatnonzero(lower[arc] > draw)
            while len(above):
                arc[above] -= 1
                above = above[lower[arc[above]] > draw[above]]
            steps.append((live, symbol[arc]))
            node = source[arc].astype(np.int64)
            counts[live] += 1
            on = node >= len(words)
            node, live, state = node[on], live[on], state[on]
        ends = np.cumsum(counts)
        symbols = np.empty(ends[-1], dtype=np.int64)
        for t, (at, found) in enumerate(steps):
            symbols[ends[at] - 1 - t] = found
        owner = np.repeat(np.arange(len(which)), counts)
        # A symbol is one piece, or the bytes of a character that has none.
        spelt = [self.byte[list(chr(c).encode())] for c in strange.tolist()]
        pool = np.concatenate([np.arange(self.size, dtype=np.int32), *spelt])
        widths = np.concatenate([np.ones(self.size, dtype=np.int64), np.array([len(s) for s in spelt], dtype=np.int64)])
        starts = np.cumsum(widths) - widths
        width = widths[symbols]
        return pool[ranges(starts[symbols], width)], np.bincount(owner, width, minlength=len(which)).astype(np.int64)

    def sampled(self, texts, keys, seed=0):
        """(ids, count of ids per text) of one sampled path for each text; null and empty texts have none."""
        counts, out = [], [np.zeros(0, dtype=np.int32)]
        rows, sizes, seeds, begins, waiting = [], [], [], [], []
        held = 0

        def flush():
            number = defaultdict()
            number.default_factory = number.__len__
            which = np.fromiter(map(number.__getitem__, waiting), dtype=np.int64, count=len(waiting))
            # The table refers to itself by this, and would stay with its words until the collector comes by.
            number.default_factory = None
            each = np.array(sizes)
            with np.errstate(over="ignore"):
                place = ranges(np.array(begins), each).astype(np.uint64)
                start = mixed(np.repeat(np.array(seeds, dtype=np.uint64), each) + mixed(place + np.uint64(1)))
            ids, per_word = self.drawn(list(number), which, start)
            out.append(ids)
            # A text may reach over several rounds, so the sums of its parts are added.
            sums = np.add.reduceat(per_word, np.cumsum(each) - each)
            for row, n in zip(rows, sums.tolist()):
                counts[row] += n
            for kept in (rows, sizes, seeds, begins, waiting):
                kept.clear()

        for row, (text, key) in enumerate(zip(texts, keys)):
            counts.append(0)
            if not text:
                continue
            digest = int.from_bytes(hashlib.blake2b(f"{seed}:{key}".encode(), digest_size=8).digest(), "little")
            begin = 0
            for part in words_of(" " + text):
                rows.append(row)
                sizes.append(len(part))
                seeds.append(digest)
                begins.append(begin)
                waiting.extend(part)
                begin += len(part)
                held += sum(map(len, part))
                if held >= TOGETHER:
                    flush()
                    held = 0
        if waiting:
            flush()
        return np.concatenate(out), np.array(counts, dtype=np.int64)

    def bytes_of(self, ids, counts):
        """(bytes, count of bytes per row) of rows of ids, without the space put before each text."""
        ends = np.cumsum(counts)
        heads, sizes, out = (ends - counts)[counts > 0], np.zeros(len(counts), dtype=np.int64), [np.zeros(0, dtype=np.uint8)]
        for low in range(0, len(ids), DECODED):
            part = ids[low:low + DECODED]
            start, size = self.raw_start[part], self.raw_size[part]
            head = heads[np.searchsorted(heads, low):np.searchsorted(heads, low + len(part))] - low
            spaced = head[(size[head] > 0) & (self.raw[start[head]] == 0x20)]
            start[spaced] += 1
            size[spaced] -= 1
            out.append(self.raw[ranges(start, size)])
            upto = np.r_[0, np.cumsum(size)]
            sizes += upto[np.clip(ends - low, 0, len(part))] - upto[np.clip(ends - counts - low, 0, len(part))]
        return np.concatenate(out), sizes


@lru_cache(maxsize=2)
def vocabulary(model, alpha):
    return Vocabulary(model, alpha)


def parts(sizes, limit):
    """(first row, number of rows) of runs of rows of `limit` together at most, or of one row that is larger."""
    ends, low = np.cumsum(sizes), 0
    while low < len(ends):
        high = max(low + 1, int(np.searchsorted(ends, ends[low] - sizes[low] + limit, side="right")))
        yield low, high - low
        low = high


def offsets(counts):
    return pa.array(np.r_[0, np.cumsum(counts)], pa.int32())


def cut(v, texts, keys, seed):
    """Arrow lists of the ids of an Arrow batch of texts, a part of its rows after the other."""
    sizes = np.asarray(pa.compute.binary_length(texts).fill_null(0), dtype=np.int64)
    for low, n in parts(sizes, HANDED):
        part = texts.slice(low, n)
        ids, counts = v.sampled(part.to_pylist(), keys.slice(low, n).to_pylist(), seed)
        yield pa.ListArray.from_arrays(offsets(counts), pa.array(ids, pa.int32()), mask=part.is_null())


def spelt(v, rows):
    """Arrow texts of Arrow lists of ids."""
    counts = np.asarray(rows.value_lengths().fill_null(0), dtype=np.int64)
    raw, sizes = v.bytes_of(np.asarray(rows.flatten()), counts)
    texts = pa.StringArray.from_buffers(len(rows), offsets(sizes).buffers()[1], pa.py_buffer(raw.tobytes()))
    return pa.compute.if_else(rows.is_null(), pa.scalar(None, pa.string()), texts)


def seeded_by(key):
    return F.coalesce(key.cast("string"), F.lit(""))


def encoded(text, key, model=MODEL, alpha=ALPHA, seed=0):
    """Column of piece ids for a text column and a key column."""

    # Not a function of whole batches: Spark would run it once more inside each function of its result.
    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch in batches:
            yield from cut(vocabulary(model, alpha), *batch, seed)
            del batch

    return encode(text, seeded_by(key))


def decoded(ids, model=MODEL):
    """Column of texts for a column of piece ids."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            sizes = 4 * np.asarray(batch.value_lengths().fill_null(0), dtype=np.int64)
            for low, n in parts(sizes, HANDED):
                yield spelt(vocabulary(model, ALPHA), batch.slice(low, n))
            del batch

    return decode(ids)


def round_trip(df, ids, back, text="text", key="doc_id", model=MODEL, alpha=ALPHA, seed=0):
    """The rows with the piece ids of their text as column `ids`, and the text those ids decode to as column `back`.

    The columns of `encoded` and `decoded` made in one pass: a part of the rows is cut, its ids are decoded, and it is
    handed on. Asked for one by one, the second takes a Python process of its own and batches of 10,000 rows of ids.
    """
    columns = [c for c in df.columns if c not in (ids, back)]
    at, names = df.columns.index(text), [*columns, ids, back]
    kept = [df.columns.index(c) for c in columns]
    kinds = [df.schema[c] for c in columns]

    def both(batch):
        v, texts, low = vocabulary(model, alpha), batch.column(at), 0
        for rows in cut(v, texts, batch.column(batch.num_columns - 1), seed):
            part = batch.slice(low, len(rows))
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), rows, spelt(v, rows)], names)
            low += len(rows)

    def go(batches):
        for batch in batches:
            yield from both(batch)
            del batch

    made = StructType([*kinds, StructField(ids, ArrayType(IntegerType())), StructField(back, StringType())])
    return df.select("*", seeded_by(df[key])).mapInArrow(go, made)
