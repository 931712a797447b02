"""Fill-in-the-middle transformation of texts held as ropes.

A rope is a balanced tree over leaves of about ``LEAF`` code points.  Leaves and
inner nodes cache how many units start in them and how many code points they hold,
so a split at a unit rank or at a code point walks one path and cuts one leaf, and
subtrees are shared, not copied.  A document's tree is split at two unit ranks, the
three parts and the sentinels are joined in the order of the form, and the text is written
out once.  The inverse builds the rope of the output, splits it at the code points of
its sentinels, and joins the parts in their first order.

Units are runs of A-Z and a-z, and every other code point by itself.  A unit
counts where it starts, so leaves may be cut anywhere.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from takepick.llm.common import fresh, text_batches

LEAF = 4096
UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")
LETTERS = re.compile("[A-Za-z]+")
#: What stands before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


class Node(NamedTuple):
    """A leaf has a text, an inner node two subtrees; ``inside`` says that a leaf begins within a unit."""

    units: int
    chars: int
    text: str = ""
    inside: bool = False
    left: "Node | None" = None
    right: "Node | None" = None


EMPTY = Node(0, 0)


def leaf(text: str, inside: bool = False) -> Node:
    return Node(len(UNIT.findall(text)) - inside, len(text), text, inside)


def join(a: Node, b: Node) -> Node:
    if not a.chars or not b.chars:
        return a if a.chars else b
    return Node(a.units + b.units, a.chars + b.chars, left=a, right=b)


def rope(text: str, size: int = LEAF) -> Node:
    """A balanced rope of a text."""
    if len(text) <= size:
        return leaf(text)
    cuts = range(0, len(text), size)
    level = [leaf(text[i : i + size], i > 0 and LETTERS.fullmatch(text[i - 1 : i + 1]) is not None) for i in cuts]
    while len(level) > 1:
        level = [join(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def split(node: Node, at: int, by_units: bool) -> tuple[Node, Node]:
    """The rope before and from unit ``at`` (or code point ``at``) on."""
    before, after = [], []  # subtrees left and right of the path, outermost first
    while node.left is not None:
        n = node.left.units if by_units else node.left.chars
        # at a boundary the first unit of the right subtree may start further on, after the rest of one
        if at < n or at == n and not by_units:
            after.append(node.right)
            node = node.left
        else:
            before.append(node.left)
            node, at = node.right, at - n
    if at >= (node.units if by_units else node.chars):
        left, right = node, EMPTY
    else:
        cut = next(islice(UNIT.finditer(node.text), at + node.inside, None)).start() if by_units else at
        inside = cut > 0 and not by_units and LETTERS.fullmatch(node.text[cut - 1 : cut + 1]) is not None
        left, right = (leaf(node.text[:cut], node.inside), leaf(node.text[cut:], inside)) if cut else (EMPTY, node)
    for x in reversed(before):
        left = join(x, left)
    for x in reversed(after):
        right = join(right, x)
    return left, right


def written(node: Node) -> str:
    parts, todo = [], [node]
    while todo:
        node = todo.pop()
        if node.left is None:
            parts.append(node.text)
        else:
            todo += (node.right, node.left)
    return "".join(parts)


def choose(doc_id: int | None, units: int, text: str, plain: int, spm: int) -> tuple[str, int, int]:
    """Form and the two unit ranks of a document, from the hash of its id."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (units + 1), h[1] % (units + 1)))
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= 100 - plain:
        return "plain", a, b
    return "spm" if h[3] % 100 < spm else "psm", a, b


def transform(text: str, doc_id: int | None, plain: int = 10, spm: int = 20) -> tuple[str, str, int, int | None, int | None]:
    """Output, form, units, and the code points of prefix and middle."""
    whole = rope(text)
    form, a, b = choose(doc_id, whole.units, text, plain, spm)
    if form == "plain":
        return text, form, whole.units, None, None
    prefix, rest = split(whole, a, True)
    middle, suffix = split(rest, b - a, True)
    first, second, third = leaf(PREFIX), leaf(SUFFIX), leaf(MIDDLE)
    if form == "psm":
        out = join(join(join(first, prefix), join(second, suffix)), join(third, middle))
    else:
        out = join(join(second, suffix), join(join(first, prefix), join(third, middle)))
    return written(out), form, whole.units, prefix.chars, middle.chars


def restore(output: str, form: str) -> str:
    """The text that ``transform`` made the output of; its parts hold no sentinel."""
    if form == "plain":
        return output
    marks = (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE)
    rest, at, parts = rope(output), 0, {}
    ends = [output.index(m) for m in marks[1:]] + [len(output)]
    for mark, end in zip(marks, ends):
        part, rest = split(rest, end - at, False)
        parts[mark], at = split(part, len(mark), False)[1], end
    return written(join(join(parts[PREFIX], parts[MIDDLE]), parts[SUFFIX]))


def fill_in_middle(docs: DataFrame, plain: int = 10, spm: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all rows and columns, and n_units, form, output, restored, prefix_chars, middle_chars.

    ``plain`` and ``spm`` are percentages: of documents left as they are, and of the others
    those whose suffix comes first.  Ranks and form follow from the hash of the id, so
    rows repeated with one id and text have one result; a null id is hashed as no
    digits.  A null text is empty.  Empty texts, and texts that hold a sentinel, stay
    plain: output is the text, prefix_chars and middle_chars are null.  ``restored`` is read
    back from output and form.  A text is one row and must fit a task.  No rows give no rows.  A column of the
    documents that has one of the new names keeps it, and the new one gets an underscore in front.
    """
    names = fresh(docs, "n_units", "form", "output", "restored", "prefix_chars", "middle_chars")
    kinds = ("long", "string", "string", "string", "long", "long")
    i, t = fresh(docs, "tp_id", "tp_text")
    schema = StructType(list(docs.schema.fields))
    for name, kind in zip(names, kinds):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, t, owner="rope"):
            rows = []
            for doc, text in zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                output, form, units, prefix, middle = transform(text, doc, plain, spm)
                rows.append((units, form, output, restore(output, form), prefix, middle))
            types = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
            made = [pa.array([r[c] for r in rows], x) for c, x in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *made], [*batch.schema.names[:-2], *names])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select("*", F.col(id_col).cast("long").alias(i), text.alias(t)).mapInArrow(run, schema)
