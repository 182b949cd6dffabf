"""Claims that can be compared, their contradictions, and which side has authority."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestack.functions import strings as S
from lodestack.operators import intake
from lodestack.operators.ranking import placed
from lodestack.session import materialize, share_code, unused


def expand_procedures(procedures: DataFrame) -> DataFrame:
    """Claims of procedures (record_id, title, steps, warnings): one for each step and each warning.

    steps holds (step_number, instruction), warnings (severity, text, context).
    """
    step = procedures.select("record_id", "title", F.explode("steps").alias("s"))
    number = F.lpad(F.col("s.step_number").cast("string"), 3, "0")
    steps = step.select(
        F.concat("record_id", F.lit("::step-"), number).alias("claim_id"),
        F.lit("procedure_step").alias("claim_type"),
        F.concat(S.slug(F.col("title")), F.lit("::step-"), number).alias("subject"),
        S.fold(F.col("s.instruction")).alias("signature"),
    )
    warning = procedures.select("record_id", "title", F.posexplode("warnings").alias("i", "w"))
    warnings = warning.select(
        F.concat("record_id", F.lit("::warning-"), F.lpad((F.col("i") + 1).cast("string"), 3, "0")).alias("claim_id"),
        F.lit("warning").alias("claim_type"),
        S.slug(F.coalesce("w.context", "title")).alias("subject"),
        F.concat_ws("|", S.fold(F.col("w.severity")), S.fold(F.col("w.text"))).alias("signature"),
    )
    return steps.unionByName(warnings)


def comparable_pairs(claims: DataFrame) -> DataFrame:
    """Pairs a < b of claims on one subject within one scope whose signatures differ.

    claims: claim_id, claim_type, subject, manufacturer, family, models, scope_revision, signature and
    what else is to be kept. Revisions are compared folded and without white space at their ends; a blank one
    is none. Claims meet by equality of type, subject, manufacturer and family, so a
    hot subject is one key of a sort-merge join, which AQE splits; models and revisions only filter.
    """
    keys = ["claim_type", "subject", "manufacturer", "family"]
    claims = claims.withColumn("scope_revision", F.nullif(S.fold(S.strip(F.col("scope_revision"))), F.lit("")))
    side = lambda p: claims.select(*keys, *[F.col(c).alias(f"{p}_{c}") for c in claims.columns if c not in keys])
    pairs = side("a").join(side("b"), keys)
    one = F.when((F.size("a_models") == 1) & (F.size("b_models") == 1), F.col("a_models")[0] == F.col("b_models")[0])  # no sets are made for these
    models = (F.size("a_models") == 0) | (F.size("b_models") == 0) | one.otherwise(F.arrays_overlap("a_models", "b_models"))
    revision = F.col("a_scope_revision").isNull() | F.col("b_scope_revision").isNull() | (F.col("a_scope_revision") == F.col("b_scope_revision"))
    return pairs.where((F.col("a_claim_id") < F.col("b_claim_id")) & (F.col("a_signature") != F.col("b_signature")) & models & revision)


def _negates(tokens: Column) -> Column:
    return F.arrays_overlap(tokens, F.array(*map(F.lit, S.NEGATIONS)))


def _contradict(tokens: tuple[Column, Column], folded: tuple[Column, Column], negates: tuple[Column, Column]) -> Column:
    left, right = tokens
    sizes = F.size(left) + F.size(right)
    # both / (sizes - both) >= 7 / 20 in whole numbers; texts of too different sizes needn't be intersected
    alike = (27 * F.least(F.size(left), F.size(right)) >= 7 * sizes) & (27 * F.size(F.array_intersect(left, right)) >= 7 * sizes)
    return F.when((F.size(left) == 0) | (F.size(right) == 0), folded[0] != folded[1]).otherwise((negates[0] != negates[1]) | alike)


def text_contradicts(left: Column, right: Column) -> Column:
    """Texts contradict if just one of them negates, or if they share 35 % of their meaningful tokens; without such, if they differ."""
    tokens = S.tokens(left), S.tokens(right)
    return _contradict(tokens, (S.fold(left), S.fold(right)), (_negates(tokens[0]), _negates(tokens[1])))


def with_text_marks(df: DataFrame, text: str) -> DataFrame:
    """df with what ``text_contradicts`` goes by, made once for each text: tokens, folded, negates."""
    marked = df.withColumns({"tokens": S.tokens(F.col(text)), "folded": S.fold(F.col(text))})
    return marked.withColumn("negates", _negates(F.col("tokens")))


def marks_contradict(a: str = "a_", b: str = "b_") -> Column:
    """``text_contradicts`` of two sides that have marks."""
    return _contradict(*[(F.col(f"{a}{name}"), F.col(f"{b}{name}")) for name in ("tokens", "folded", "negates")])


#: What makes claims of one kind and scope that say the same one class.
CLASS = ("claim_type", "subject", "manufacturer", "family", "models", "scope_revision", "signature", "folded")
_TEXTUAL = ("procedure_step", "warning")
#: Claims, and tokens of their texts, in a block, about: classes of one subject and scope meet in pairs of blocks, so that a hot subject is many tasks.
BLOCK = 1 << 13
TOKENS = 1 << 21
#: Classes of a block that are compared at once, and pairs of claims that are made at once.
_AT_ONCE = 1 << 10
_PAIRS = 1 << 20
#: The claims of a class of short texts are held in so many parts.
PARTS = 64
#: Claims whose pairs are put into order together, as a power of two, and how many pairs at once.
SLICE_BITS = 10
SORTED = 1 << 22
#: Columns of a dense slice when shared items are counted.
_SLICE = 4096


def _marked(claims: DataFrame, within: tuple[str, ...]) -> DataFrame:
    """claims with what their class has in common and class_id, a digest of that. Signatures and folded texts are digests too: they are only compared."""
    own = S.fold(S.strip(F.col("scope_revision")))
    models = F.array_sort(F.array_distinct(F.coalesce("models", F.array().cast("array<string>"))))
    digest = lambda c: F.unhex(F.md5(c))
    plain = claims.withColumns({"scope_revision": F.when(own != "", own), "models": models, "folded": digest(S.fold(F.col("claim_text"))), "signature": digest(F.col("signature"))})
    return plain.withColumn("class_id", F.substring(F.unhex(F.sha2(F.to_json(F.struct(*within, *CLASS), {"ignoreNullFields": "false"}), 256)), 1, 16))


def _with_marks(classes: DataFrame) -> DataFrame:
    """classes with the marks of their texts; folded stays a digest."""
    return with_text_marks(classes.withColumnRenamed("folded", "digest"), "claim_text").drop("folded", "claim_text").withColumnRenamed("digest", "folded")


def claim_classes(claims: DataFrame, within: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(classes, members) of claims of one subject and scope that say the same.

    claims: claim_id, claim_type, subject, manufacturer, family, models, scope_revision, signature, claim_text and ``within``.
    Members are the claims with their class_id, a digest of what the class has in common; so a claim finds its class
    without a join. Classes have that, ``claims`` (how many), ``head`` (the first claim) and the marks of their text.
    """
    members = _marked(claims, within)
    classes = members.groupBy("class_id").agg(*[F.first(c).alias(c) for c in (*within, *CLASS)], F.first("claim_text").alias("claim_text"), F.count(F.lit(1)).alias("claims"), F.min("claim_id").alias("head"))
    return _with_marks(classes), members


def class_parts(claims: DataFrame, within: tuple[str, ...] = (), carry: tuple[str, ...] = ()) -> DataFrame:
    """The classes of ``claim_classes`` in parts that hold their claims: ``members``, structs of claim_id and ``carry``.

    Classes of short texts, which many claims may share, have PARTS parts, others one; so each claim comes from what made its class, without a join.
    """
    members = _marked(claims.where("claim_id IS NOT NULL"), within)
    part = F.when(F.length("claim_text") < 256, F.pmod(F.xxhash64("claim_id"), F.lit(PARTS))).otherwise(0).cast("int")
    held = members.withColumn("part", part).groupBy("class_id", "part")
    rows = held.agg(*[F.first(c).alias(c) for c in (*within, *CLASS)], F.first("claim_text").alias("claim_text"), F.count(F.lit(1)).alias("claims"), F.collect_list(F.struct("claim_id", *carry)).alias("members"))
    return _with_marks(rows)


def _shared(a: pa.ListArray, b: pa.ListArray) -> np.ndarray:
    """How many items each list of a shares with each of b; lists hold each item once."""
    rows = [np.repeat(np.arange(len(x)), np.diff(x.offsets.to_numpy())) for x in (a, b)]
    flat = [x.flatten().to_numpy(zero_copy_only=False) for x in (a, b)]
    common = np.intersect1d(*flat)
    out = np.zeros((len(a), len(b)), np.float32)
    at = [np.minimum(np.searchsorted(common, x), max(len(common) - 1, 0)) for x in flat]
    held = [common[k] == x if len(common) else np.zeros(len(x), bool) for k, x in zip(at, flat, strict=True)]
    for low in range(0, len(common), _SLICE):
        width = min(_SLICE, len(common) - low)
        sides = []
        for n, row, k, ok in zip((len(a), len(b)), rows, at, held, strict=True):
            here = ok & (k >= low) & (k < low + width)
            sides.append(np.zeros((n, width), np.float32))
            sides[-1][row[here], k[here] - low] = 1
        out += sides[0] @ sides[1].T
    return out


def _codes(values: pa.ChunkedArray) -> np.ndarray:
    """Values as whole numbers in their order; null is -1."""
    own = values.combine_chunks().dictionary_encode()
    place = np.empty(len(own.dictionary) + 1, np.int64)
    place[pc.sort_indices(own.dictionary).to_numpy()] = np.arange(len(own.dictionary))
    place[-1] = -1
    return place[own.indices.fill_null(len(own.dictionary)).to_numpy()]


def _facing(t: pa.Table, model: str | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows p and q of a pair of blocks and which of them contradict, as a matrix; each pair of rows once.

    Blocks of a model hold classes that have it and give pairs of which that is the first shared one; others hold classes without models on the left.
    side: 0 left, 1 right, 2 both.
    """
    side = t["side"].to_numpy()
    left, right, one = np.flatnonzero(side != 1), np.flatnonzero(side != 0), bool((side == 2).any())
    if not len(left) or not len(right):
        return
    ids, revisions, signatures, folded = (_codes(t[c]) for c in ("class_id", "scope_revision", "signature", "folded"))
    models = t["models"].to_pylist()
    listed = np.array([len(x) > 0 for x in models])
    before = pa.array([[m for m in own if m is not None and m < model] if model is not None else [] for own in models], pa.list_(pa.string()))
    earlier = np.diff(before.offsets.to_numpy()) > 0
    textual = t["tokens"].null_count < len(t)
    tokens = t["tokens"].combine_chunks()
    n = tokens.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    negates = t["negates"].combine_chunks().fill_null(False).to_numpy(zero_copy_only=False)
    for x in range(0, len(left), _AT_ONCE):
        for y in range(x if one else 0, len(right), _AT_ONCE):
            p, q = left[x : x + _AT_ONCE], right[y : y + _AT_ONCE]
            own, other = p[:, None], q[None, :]
            found = (signatures[own] != signatures[other]) & ((revisions[own] < 0) | (revisions[other] < 0) | (revisions[own] == revisions[other]))
            if model is None:
                found &= listed[other] | (ids[own] < ids[other])
            elif earlier[p].any() and earlier[q].any():
                found &= _shared(before.take(pa.array(p)), before.take(pa.array(q))) == 0
            if one and x == y:
                found &= np.triu(np.ones(found.shape, bool), 1)
            if textual:
                bare = (n[own] == 0) | (n[other] == 0)
                flips = negates[own] != negates[other]
                asked = found & ~bare & ~flips & (27 * np.minimum(n[own], n[other]) >= 7 * (n[own] + n[other]))
                i, j = np.flatnonzero(asked.any(axis=1)), np.flatnonzero(asked.any(axis=0))
                if len(i):
                    shared = _shared(tokens.take(pa.array(p[i])), tokens.take(pa.array(q[j]))).astype(np.int64)
                    asked[np.ix_(i, j)] &= 27 * shared >= 7 * (n[p[i]][:, None] + n[q[j]][None, :])
                found &= np.where(bare, folded[own] != folded[other], flips | asked)
            if found.any():
                yield p, q, found


def _many(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The blocks of each key."""
    held = F.sum("claims") if "members" in df.columns else F.count(F.lit(1))
    return df.groupBy(*keys).agg(F.ceil(F.greatest(held / BLOCK, F.sum(F.coalesce(F.size("tokens"), F.lit(0))) / TOKENS)).cast("int").alias(name))


def _blocks(a: DataFrame, b: DataFrame, keys: list[str], *id: str) -> tuple[DataFrame, DataFrame]:
    """a and b with a_block and b_block, so that each row of a meets each of b with its keys in just one pair of blocks.

    How many blocks there are is written first, so that it is known to be small before the rows would be shuffled to meet it.
    """
    blocks = materialize(_many(a, keys, "a_blocks").join(_many(b, keys, "b_blocks"), keys), "blocks")

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        placed_ = df.join(blocks, keys).withColumn(f"{own}_block", F.pmod(F.xxhash64(*id), F.col(f"{own}_blocks")).cast("int"))
        return placed_.withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1))).drop("a_blocks", "b_blocks")

    return dealt(a, "a", "b"), dealt(b, "b", "a")


def _own_blocks(df: DataFrame, keys: list[str], *id: str) -> DataFrame:
    """df with a_block, b_block (not before a_block) and side, so that all rows of a key meet in just one pair of blocks; a row is sent once to each."""
    several = materialize(_many(df, keys, "blocks").where("blocks > 1"), "blocks")
    dealt = df.dropna(subset=keys).join(several, keys, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", F.pmod(F.xxhash64(*id), F.col("blocks")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    return met.withColumns({"a_block": F.least("own", "other"), "b_block": F.greatest("own", "other"), "side": side}).drop("own", "other", "blocks")


def _meeting(classes: DataFrame, within: tuple[str, ...], found: Callable[[pa.Table, str | None], Iterator[pa.RecordBatch]], columns: str) -> DataFrame:
    """What ``found`` gives for each pair of blocks of classes that may contradict: rows of ``columns``, after those of ``within``.

    Classes of one type, subject, manufacturer and family meet where they share a model, through a list of the
    classes by model, and count at the first that they share; those without models meet all others. Revisions are equal or missing
    on a side. Values and alarms contradict if their signatures differ, steps and warnings if their texts do.
    ``classes`` is a written table without texts, of ``_plain``.
    """
    share_code(classes.sparkSession)
    keys = [*within, "claim_type", "subject", "manufacturer", "family"]
    met = [*keys, "model", "a_block", "b_block"]
    rest = [c for c in classes.columns if c not in keys]
    id = [c for c in ("class_id", "part") if c in classes.columns]
    listed = classes.where(F.size("models") > 0).withColumn("model", F.explode("models"))
    left, right = _blocks(classes.where(F.size("models") == 0), classes, keys, *id)
    none = F.lit(None).cast("string").alias("model")
    sides = [df.select(*keys, none, "a_block", "b_block", F.lit(k).alias("side"), *rest) for k, df in enumerate((left, right))]
    rows = reduce(DataFrame.unionByName, [_own_blocks(listed, [*keys, "model"], *id).select(*met, "side", *rest), *sides])
    kinds = "".join(f"`{c}` {classes.schema[c].dataType.simpleString()}, " for c in within)
    count, model_at = len(within), len(keys)

    def of_blocks(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches))
        for out in found(t, key[model_at].as_py()):
            own = [pa.repeat(value, len(out)) for value in key[:count]]
            yield pa.RecordBatch.from_arrays([*own, *out.columns], names=[*within, *out.schema.names])

    return rows.groupBy(*met).applyInArrow(of_blocks, kinds + columns)


def _plain(classes: DataFrame, within: tuple[str, ...], *more: str) -> DataFrame:
    """What is compared of classes, written once, without texts: tokens by 64-bit hash, and only those of steps and warnings."""
    hashed = F.when(F.col("claim_type").isin(*_TEXTUAL), F.array_distinct(F.transform("tokens", lambda t: F.xxhash64(t))))
    rows = classes.select(*within, "claim_type", "subject", "manufacturer", "family", "class_id", "models", "scope_revision", "signature", hashed.alias("tokens"), "folded", "negates", "claims", *more)
    return materialize(rows, "classes")


def class_pairs(classes: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """Pairs (a_class, b_class) of classes that contradict, a before b."""

    def pairs(t: pa.Table, model: str | None) -> Iterator[pa.RecordBatch]:
        ids = t["class_id"].combine_chunks()
        for p, q, found in _facing(t, model):
            i, j = np.nonzero(found)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(p[i])), ids.take(pa.array(q[j]))], names=["a_class", "b_class"])

    low, high = F.least("a_class", "b_class").alias("a_class"), F.greatest("a_class", "b_class").alias("b_class")
    return _meeting(_plain(classes, within), within, pairs, "a_class binary, b_class binary").select(*within, low, high)


def opposed_classes(classes: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """Classes (``within``, class_id, head, claims) with ``opposed``, how many claims contradict each of theirs. Blocks send sums, never pairs."""

    def sums(t: pa.Table, model: str | None) -> Iterator[pa.RecordBatch]:
        weight = t["claims"].to_numpy().astype(np.float64)
        out = np.zeros(len(t))
        for p, q, found in _facing(t, model):
            cells = found.astype(np.float64)
            out[p] += cells @ weight[q]
            out[q] += weight[p] @ cells
        some = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([t["class_id"].combine_chunks().take(pa.array(some)), pa.array(out[some].astype(np.int64))], names=["class_id", "opposed"])

    held = _plain(classes, within, "head")
    total = _meeting(held.drop("head"), within, sums, "class_id binary, opposed long").groupBy("class_id").agg(F.sum("opposed").alias("opposed"))
    return held.select(*within, "class_id", "head", "claims").join(total, "class_id", "left").withColumn("opposed", F.coalesce("opposed", F.lit(0)))


def _claim_pairs(t: pa.Table, model: str | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of claims of a pair of blocks, by their numbers among the rows' members: the smaller id and the greater, some _PAIRS at once."""
    lists = t["members"].combine_chunks()
    first, n = lists.offsets.to_numpy()[:-1].astype(np.int64), lists.value_lengths().to_numpy().astype(np.int64)
    name = _codes(pa.chunked_array([lists.flatten().field("claim_id")]))

    def ordered(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        apart = name[a] != name[b]
        a, b = a[apart], b[apart]
        swap = name[a] > name[b]
        return np.where(swap, b, a), np.where(swap, a, b)

    for p, q, found in _facing(t, model):
        i, j = np.nonzero(found)
        i, j = p[i], q[j]
        many = n[i] * n[j]
        ends = np.cumsum(many)
        at = 0
        while at < len(i):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PAIRS, "right")))
            if many[at] > _PAIRS:
                step = max(1, _PAIRS // int(n[j[at]]))
                theirs = first[j[at]] + np.arange(n[j[at]])
                for low in range(0, int(n[i[at]]), step):
                    own = first[i[at]] + np.arange(low, min(low + step, int(n[i[at]])))
                    yield ordered(np.repeat(own, len(theirs)), np.tile(theirs, len(own)))
            else:
                some = slice(at, stop)
                cell = np.repeat(np.arange(at, stop), many[some])
                k = np.arange(len(cell)) - np.repeat(ends[some] - many[some] - (ends[at] - many[at]), many[some])
                yield ordered(first[i[cell]] + k // n[j[cell]], first[j[cell]] + k % n[j[cell]])
            at = stop


def _cut(length: int, step: int = 1 << 16) -> Iterator[slice]:
    return (slice(k, k + step) for k in range(0, length, step))


def claim_pairs(parts: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """Pairs (a_claim_id before b_claim_id) of claims that contradict, each once, from ``class_parts``. Pairs are made where their classes meet and aren't shuffled."""

    def pairs(t: pa.Table, model: str | None) -> Iterator[pa.RecordBatch]:
        names = t["members"].combine_chunks().flatten().field("claim_id")
        for a, b in _claim_pairs(t, model):
            for k in _cut(len(a)):
                yield pa.RecordBatch.from_arrays([names.take(pa.array(a[k])), names.take(pa.array(b[k]))], names=["a_claim_id", "b_claim_id"])

    return _meeting(_plain(parts, within, "part", "members"), within, pairs, "a_claim_id string, b_claim_id string")


def _pressed(*arrays: np.ndarray) -> bytes:
    """Whole numbers, each array as byte planes, compressed."""
    raw = np.array([len(arrays), *[x for a in arrays for x in (len(a), a.itemsize)]], np.uint32).tobytes() + b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays)
    return len(raw).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _opened(raw: bytes, *kinds: type) -> list[np.ndarray]:
    plain = pa.decompress(raw[4:], int.from_bytes(raw[:4], "little"), codec="zstd", asbytes=True)
    at, out = 4 + 8 * len(kinds), []
    for kind, (n, width) in zip(kinds, np.frombuffer(plain, np.uint32, 2 * len(kinds), 4).reshape(-1, 2).tolist(), strict=True):
        out.append(np.ascontiguousarray(np.frombuffer(plain, np.uint8, n * width, at).reshape(width, n).T).view(kind).reshape(n))
        at += n * width
    return out


def _said(names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Strings as their lengths and bytes."""
    own = names.cast(pa.binary())
    return pc.binary_length(own).to_numpy().astype(np.uint32), np.frombuffer(b"".join(own.to_pylist()), np.uint8)


def _names(lengths: np.ndarray, said: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(said.tobytes()))


_PIECE = (np.int64, np.uint32, np.uint8, np.uint32, np.uint8, np.uint32, np.uint32, np.uint8)


def _piece(no: np.ndarray, names: pa.Array, head: np.ndarray, tail: np.ndarray, mark: np.ndarray) -> bytes:
    heads, h = np.unique(head, return_inverse=True)
    tails, t = np.unique(tail, return_inverse=True)
    return _pressed(no[heads], *_said(names.take(pa.array(heads))), *_said(names.take(pa.array(tails))), h.astype(np.uint32), t.astype(np.uint32), mark)


def _in_order(before: int, raws: list[bytes], total: int) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]]:
    """Heads, tails, marks and places of the pairs of a slice in their order, by the number of the head and the name of the tail."""
    rounds = max(1, -(-total // SORTED))
    opened = [_opened(raw, *_PIECE)[:5] for raw in raws]
    numbers, where = np.unique(np.concatenate([x[0] for x in opened]), return_index=True)
    heads = pa.concat_arrays([_names(x[1], x[2]) for x in opened]).take(pa.array(where))
    tails = pa.concat_arrays([_names(x[3], x[4]) for x in opened]).dictionary_encode()
    order = pc.sort_indices(tails.dictionary)
    place = np.empty(len(order), np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    rank, names = place[tails.indices.to_numpy()], tails.dictionary.take(order)
    starts = np.cumsum([0, *[len(x[3]) for x in opened]])
    own = [np.searchsorted(numbers, x[0]) for x in opened]
    del opened, tails
    edges = [len(numbers) * k // rounds for k in range(rounds + 1)]
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        found: list[list[np.ndarray]] = [[], [], []]
        for k, raw in enumerate(raws):
            h, t, mark = _opened(raw, *_PIECE)[5:]
            h = own[k][h]
            some = slice(None) if rounds == 1 else np.flatnonzero((h >= low) & (h < high))
            for column, values in zip(found, (h[some], rank[starts[k] + t[some]], mark[some]), strict=True):
                column.append(values)
        h, t, mark = (np.concatenate(x) for x in found)
        sort = np.argsort(h * len(rank) + t, kind="stable")
        for k in _cut(len(sort)):
            at = sort[k]
            yield heads.take(pa.array(h[at])), names.take(pa.array(t[at])), mark[at], before + 1 + np.arange(k.start, k.start + len(at))
        before += len(sort)


def ordered_pairs(parts: DataFrame, bucket: str, order: str | None = None, with_members: Callable[[DataFrame], DataFrame] | None = None, first: Callable[[pa.Array, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]] | None = None) -> DataFrame:
    """(bucket, head, tail, mark, place): pairs of claims that contradict, in each bucket in the order of their heads, by ``order`` and id, and their tails' ids.

    The head is the claim with the smaller id, or what ``first`` says of members a and b of smaller and greater ids: whether that is a, and a mark
    of the pair, a small number. ``parts`` are ``class_parts`` that carry ``order``; ``with_members`` adds to members, a row each, what ``first`` asks for.
    Claims are numbered in the order of heads. Pairs go by slices of these numbers, packed, with the names that they have; how many there are before a slice is
    a sum of counts. So no pair is a row before it has its place.
    """
    parts = _plain(parts, (bucket,), "part", "members")
    member = parts.select(bucket, "class_id", "part", F.explode("members").alias("m")).select(bucket, "class_id", "part", "m.*")
    by = [order, "claim_id"] if order else ["claim_id"]
    numbered = placed(member, [bucket], by, "no")
    numbered = numbered.withColumn("no", F.min("no").over(Window.partitionBy(bucket, *by)))  # equal claims are equal in the order
    numbered = with_members(numbered) if with_members else numbered
    carried = [c for c in numbered.columns if c not in (bucket, "class_id", "part")]
    lists = numbered.groupBy("class_id", "part").agg(F.collect_list(F.struct(*carried)).alias("members"))
    held = materialize(parts.drop("members").join(lists, ["class_id", "part"]), "parts")
    slices = SLICE_BITS

    def pieces(t: pa.Table, model: str | None) -> Iterator[pa.RecordBatch]:
        own = t["members"].combine_chunks().flatten()
        no, names = own.field("no").to_numpy(), own.field("claim_id")
        out: list[list] = [[], [], []]
        size = 0
        for a, b in _claim_pairs(t, model):
            wins, mark = first(own, a, b) if first else (np.ones(len(a), bool), np.zeros(len(a), np.uint8))
            head, tail = np.where(wins, a, b), np.where(wins, b, a)
            part = no[head] >> slices
            sort = np.argsort(part, kind="stable")
            edges = np.flatnonzero(np.diff(part[sort], prepend=-1, append=-1))
            for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                at = sort[low:high]
                raw = _piece(no, names, head[at], tail[at], mark[at])
                for column, value in zip(out, (int(part[at[0]]), high - low, raw), strict=True):
                    column.append(value)
                size += len(raw)
                if size > 1 << 21 or len(out[0]) >= 1 << 12:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, _SENT, strict=True)], names=["slice", "pairs", "raw"])
                    out, size = [[], [], []], 0
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, _SENT, strict=True)], names=["slice", "pairs", "raw"])

    sent = materialize(_meeting(held, (bucket,), pieces, "slice long, pairs long, raw binary"), "pieces")
    ends = Window.partitionBy(bucket).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = sent.groupBy(bucket, "slice").agg(F.sum("pairs").alias("total")).withColumn("before", F.coalesce(F.sum("total").over(ends), F.lit(0)))
    rows = sent.select(bucket, "slice", "raw").join(materialize(counts, "slices"), [bucket, "slice"])

    def ranked(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raws: list[bytes] = []
        for batch in batches:
            raws += batch.column("raw").to_pylist()
            before, total = (batch.column(c)[0].as_py() for c in ("before", "total"))
        for heads, tails, mark, place in _in_order(before, raws, total):
            yield pa.RecordBatch.from_arrays([pa.repeat(key[0], len(mark)), heads, tails, pa.array(mark.astype(np.int8)), pa.array(place)], names=[bucket, "head", "tail", "mark", "place"])

    return rows.groupBy(bucket, "slice").applyInArrow(ranked, f"`{bucket}` {parts.schema[bucket].dataType.simpleString()}, head string, tail string, mark byte, place long")


_SENT = (pa.int64(), pa.int64(), pa.binary())


def expanded(pairs: DataFrame, members: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """The pairs of claims (a_claim_id before b_claim_id) of pairs of classes, each once, with ``carry`` of both sides."""
    side = lambda p: members.select(F.col("class_id").alias(f"{p}_class"), *[F.col(c).alias(f"{p}_{c}") for c in ("claim_id", *carry)])
    met = pairs.join(side("a"), "a_class").join(side("b"), "b_class").where("a_claim_id <> b_claim_id")
    swap = F.col("a_claim_id") > F.col("b_claim_id")
    sides = [c for name in ("claim_id", *carry) for c in (F.when(swap, F.col(f"b_{name}")).otherwise(F.col(f"a_{name}")).alias(f"a_{name}"), F.when(swap, F.col(f"a_{name}")).otherwise(F.col(f"b_{name}")).alias(f"b_{name}"))]
    return met.select(*[c for c in pairs.columns if c not in ("a_class", "b_class")], *sides)


def authority(sources: DataFrame) -> DataFrame:
    """sources (document_type, document_class, revision) with what supersession compares: level (``precedence``), the folded type (kind) and the revision's key (edition).

    What these go by is made once for a row, in columns of its own: spelled out wherever it is named, it makes a method that the JVM doesn't compile.
    """
    kind, own, bare, slug = F.col("kind"), *(unused(sources, stem) for stem in ("class_", "bare_", "slug_"))
    folded = sources.withColumns({"kind": S.fold(F.col("document_type")), own: S.fold(F.col("document_class")), bare: S.bare(F.col("revision"))}).withColumn(slug, S.slug_of_folded(kind))
    return folded.withColumns({"level": intake.level(F.col(slug), F.col(own), F.col(bare)), "edition": S.bare_key(F.col(bare))}).drop(own, bare, slug)


def supersession(pairs: DataFrame) -> DataFrame:
    """pairs with the superseding and the superseded claim, and how sure that is. Both sides have date and ``authority``.

    The higher authority (lower level) wins: high. Within one level and document type the newer
    revision wins, or else the newer date: medium. Else the smaller id: low.
    """
    c = F.col
    lower, higher = c("a_level") < c("b_level"), c("a_level") > c("b_level")
    same_type = c("a_kind") == c("b_kind")
    ra, rb = c("a_edition"), c("b_edition")
    by_revision = same_type & ra.isNotNull() & rb.isNotNull() & (ra != rb)
    by_date = same_type & c("a_date").isNotNull() & c("b_date").isNotNull() & (c("a_date") != c("b_date"))
    a_wins = F.when(lower, True).when(higher, False).when(F.coalesce(by_revision, F.lit(False)), ra > rb).when(F.coalesce(by_date, F.lit(False)), c("a_date") > c("b_date")).otherwise(True)
    how = F.when(lower | higher, "high").when(F.coalesce(by_revision | by_date, F.lit(False)), "medium").otherwise("low")
    return pairs.withColumns(
        {"superseding": F.when(a_wins, c("a_claim_id")).otherwise(c("b_claim_id")), "superseded": F.when(a_wins, c("b_claim_id")).otherwise(c("a_claim_id")), "confidence": how}
    )


HOW_SURE = ("high", "medium", "low")


def authority_fields() -> list[Column]:
    """What ``superseding_first`` asks for of sources with ``authority`` and date."""
    return [F.col("level"), F.col("kind"), (F.col("edition.tier") * F.lit(10**18) + F.col("edition.n")).cast("long").alias("edition"), F.unix_date("date").alias("date")]


def superseding_first(members: pa.Array, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``supersession`` of pairs of members with ``authority_fields``: whether a supersedes b, and how sure that is, as a number in HOW_SURE."""
    level, kind, edition, date = (_codes(pa.chunked_array([members.field(c)])) for c in ("level", "kind", "edition", "date"))
    differ = level[a] != level[b]
    same = (kind[a] == kind[b]) & (kind[a] >= 0)
    known = lambda x: same & (x[a] >= 0) & (x[b] >= 0) & (x[a] != x[b])
    by_revision, by_date = known(edition), known(date)
    wins = np.where(differ, level[a] < level[b], np.where(by_revision, edition[a] > edition[b], np.where(by_date, date[a] > date[b], True)))
    return wins, np.where(differ, 0, np.where(by_revision | by_date, 1, 2)).astype(np.uint8)


def in_pair_order(decided: DataFrame, within: str) -> DataFrame:
    """decided (superseding, superseded) with place: contradictions and supersessions in the order of their ids, in each group."""
    return placed(decided, [within], ["superseding", "superseded"])


def reviewed(entries: DataFrame) -> DataFrame:
    """entries with review_status, from the saved_status beside them; unknown statuses are unreviewed."""
    known = F.col("saved_status").isin("unreviewed", "accepted", "rejected", "needs_followup")
    return entries.withColumn("review_status", F.when(known, F.col("saved_status")).otherwise("unreviewed"))


def merge_reviews(entries: DataFrame, decisions: DataFrame) -> DataFrame:
    """entries (candidate_key) with their saved decisions; unknown statuses are unreviewed, decisions without an entry go."""
    return reviewed(entries.join(decisions, "candidate_key", "left"))
