"""Secret scans that also look into encoded text.

A walk starts with the text itself. Every layer is scanned, then unwrapped: percent escapes
and Unicode escapes give one decoded copy of the whole layer each, a base64 run, also one over
line breaks or glued to a path, gives a layer of its own, and bytes that start gzip, zlib or
zstd streams give what these inflate to. Bytes that are not UTF-8 are read as they are, and as
text of 16- and 32-bit units. A layer whose text was seen before at the same place is not
visited again, which ends cycles. Each layer knows which span of its
parent every character came from, so a finding in any depth is reported at its place in
the original text.
"""

from __future__ import annotations

import base64
import bisect
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterstar.llm.common import free_name, over_texts

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_VALUE, MIN_ACCESS = 6, 20

# A chain of nested escapes (%2525...41, \u005cu0041) is one step: layers between
# its first and last differ in nothing but the escape itself.
PERCENT = re.compile(r"(?:%(?:25)*[0-9A-Fa-f]{2})+")
ONE_PERCENT = re.compile(r"%(?:25)*([0-9A-Fa-f]{2})")
UNICODE = re.compile(
    r"(?:\\(?:u005[cC])*u[0-9A-Fa-f]{4})+|(?:\\x[0-9A-Fa-f]{2})+|&#x[0-9A-Fa-f]{1,6};|&#[0-9]{1,7};"
    r"|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\}"
)
ONE_UNICODE = re.compile(r"u([0-9A-Fa-f]{4})(?=\\|$)")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# Such runs over single line breaks; all but the first and the last fill their lines.
WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++={0,2}"
)
PIECE = re.compile(r"[A-Za-z0-9+/_-]+")
AFTER = re.compile(r"(?<=[+/_-])[^+/_-]")  # where a run may start that is glued to something
# A finding, encoded or not, has as many such letters in a row.
LETTERS = re.compile(rb"[\t\n\r\x20-\x7e]{12}")
ENOUGH = 64  # bytes; what two letters that look like zlib's first bytes give by chance is less
# Shortest finding: token=abcdef. Text of 16- or 32-bit units has as many such letters in a row.
WIDE = [
    (codec, width, re.compile(b"(?:" + unit + b"){12}"))
    for codec, width, unit in (
        ("utf-16-le", 2, rb"[\t\n\r\x20-\x7e]\0"), ("utf-16-be", 2, rb"\0[\t\n\r\x20-\x7e]"),
        ("utf-32-le", 4, rb"[\t\n\r\x20-\x7e]\0\0\0"), ("utf-32-be", 4, rb"\0\0\0[\t\n\r\x20-\x7e]"),
    )
]
# Where compressed bytes start in a layer of decoded escapes. Its characters are UTF-8 with
# stray bytes as U+DC80 to U+DCFF, or one byte each.
PACKED = re.compile("\x1f[\x8b\udc8b]\x08|x[\x01^\x9c\xda\udc9c\udcda]|\\([\xb5\udcb5]/[\xfd\udcfd]")
LITERAL = re.compile(r"""\\([abfnrtv0\\'"/])""")
LITERALS = dict(zip("abfnrtv0", "\a\b\f\n\r\t\v\0"))
MAGIC = (b"\x1f\x8b", b"\x78\x01", b"\x78\x5e", b"\x78\x9c", b"\x78\xda", b"\x28\xb5\x2f\xfd")

CHUNK = 1024  # compressed bytes a step: up to 1 MB of deflate's output, 32 MB of zstd's
MAX_DECODED = 64 << 20  # inflated bytes of one document that are looked at in one piece
WINDOW, OVERLAP = 1 << 20, 64 << 10  # what is beyond them is read in windows
HEAD = 4096

FINDING = "struct<kind: string, start: long, end: long, depth: int, via: string, value: string>"
FINDING_TYPE = pa.struct(
    [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("depth", pa.int32()),
     ("via", pa.string()), ("value", pa.string())]
)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, kind's place in KINDS, end) of the plain patterns, leftmost first per kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        found += [
            (m.start(), 1, m.end()) for m in ACCESS.finditer(text)
            if m.end() - m.start() >= MIN_ACCESS
        ]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


@dataclass(eq=False)
class Layer:
    """Decoded text and where it came from.

    `starts` are ascending places in `text`. Piece i reaches from starts[i] to the next
    and came from its parent's span froms[i]: character by character if `plain[i]`, else
    as a whole.
    """

    text: str
    parent: Layer | None = None
    via: str = ""
    depth: int = 0
    starts: list[int] = field(default_factory=list)
    froms: list[tuple[int, int]] = field(default_factory=list)
    plain: list[bool] = field(default_factory=list)

    def original(self, start: int, end: int) -> tuple[int, int]:
        layer = self
        while layer.parent is not None:
            i = bisect.bisect_right(layer.starts, start) - 1
            j = bisect.bisect_left(layer.starts, end) - 1
            a, b = layer.froms[i][0], layer.froms[j][1]
            if layer.plain[i]:
                a += start - layer.starts[i]
            if layer.plain[j]:
                b = layer.froms[j][0] + end - layer.starts[j]
            start, end, layer = a, b, layer.parent
        return start, end

    def path(self) -> str:
        steps, layer = [], self
        while layer.parent is not None:
            steps.append(layer.via)
            layer = layer.parent
        return ">".join(reversed(steps))


def _percent(run: str) -> str:
    return bytes(int(x, 16) for x in ONE_PERCENT.findall(run)).decode("utf-8", "surrogateescape")


def _unicode(run: str) -> str | None:
    if run.startswith(("&#", "\\U", "\\u{")):
        code = int(run[2:-1]) if run[0] == "&" and run[2] != "x" else int(run[2:].strip("x{};"), 16)
        return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else None
    if run.startswith("\\x"):
        return bytes.fromhex(run.replace("\\x", "")).decode("utf-8", "surrogateescape")
    units = b"".join(int(x, 16).to_bytes(2, "big") for x in ONE_UNICODE.findall(run))
    return units.decode("utf-16-be", "surrogatepass")


def _rewritten(layer: Layer, pattern: re.Pattern, decode, via: str) -> Layer | None:
    """The layer with every run that decodes replaced; None if there is no such run."""
    new = Layer("", layer, via, layer.depth + 1)
    parts, at, last = [], 0, 0

    def add(text: str, a: int, b: int, plain: bool) -> None:
        nonlocal at
        if text:
            parts.append(text)
            new.starts.append(at)
            new.froms.append((a, b))
            new.plain.append(plain)
            at += len(text)

    changed = False
    for m in pattern.finditer(layer.text):
        decoded = decode(m[0])
        if decoded is None:
            continue
        changed = True
        add(layer.text[last:m.start()], last, m.start(), True)
        add(decoded, m.start(), m.end(), False)
        last = m.end()
    if not changed:
        return None
    add(layer.text[last:], last, len(layer.text), True)
    new.text = "".join(parts)
    return new


def _engine(data: bytes):
    """A decompressor for bytes that start with one of MAGIC."""
    if data.startswith(MAGIC[-1]):
        return zstandard.ZstdDecompressor().decompressobj()
    return zlib.decompressobj(wbits=47)


@dataclass
class Streams:
    """What was met while inflating: streams that reached their end, and others."""

    ends: int = 0
    broken: bool = False


def _cut(chunks: Iterable[bytes]) -> Iterator[bytes]:
    for chunk in chunks:
        for i in range(0, len(chunk), CHUNK):
            yield chunk[i : i + CHUNK]


def _inflate(chunks: Iterator[bytes], met: Streams) -> Iterator[bytes]:
    """The contents of the compressed streams at the start of the chunks, then the rest as it is."""
    rest = b""
    while True:
        while len(rest) < 4 and (more := next(chunks, b"")):
            rest += more
        if not rest.startswith(MAGIC):
            break
        engine, certain, held, made = _engine(rest), rest[:1] != b"x", b"", 0
        while True:
            try:
                out = engine.decompress(rest)
            except (zlib.error, zstandard.ZstdError):
                met.broken |= certain and made > 0 or made > ENOUGH
                yield held + rest
                yield from chunks
                return
            # The bytes themselves, as long as it may turn out that they are no stream.
            held = b"" if made or out else held + rest
            made += len(out)
            if out:
                yield out
            if engine.eof:
                break
            rest = next(chunks, b"")
            if not rest:
                met.broken |= certain or made > ENOUGH
                yield held
                return
        met.ends += 1
        rest = engine.unused_data.lstrip(b"\0") if certain else engine.unused_data
    yield rest
    yield from chunks


def _views(data: bytes) -> list[str]:
    """Decoded bytes as text: as UTF-8, whatever is not that replaced, and in wider units."""
    wide = set()
    if b"\0" in data:
        for codec, width, pattern in WIDE:
            first: dict[int, int] = {}
            for m in pattern.finditer(data):
                first.setdefault(m.start() % width, m.start())
            wide |= {(at, codec, shift) for shift, at in first.items()}
    return [data.decode("utf-8", "replace")] * bool(LETTERS.search(data)) + [
        data[shift:].decode(codec, "replace") for _, codec, shift in sorted(wide)
    ]


@dataclass
class Visit:
    """One document's walk: bytes that may still be inflated in one piece, and the original
    places of streams that have no end or were read in windows."""

    room: int
    unread: list[tuple[int, int]] = field(default_factory=list)


def _peek(chunks: Iterator[bytes]) -> tuple[bytes, Iterator[bytes]]:
    taken, size = [], 0
    while size < HEAD and (chunk := next(chunks, b"")):
        taken.append(chunk)
        size += len(chunk)
    return b"".join(taken)[:HEAD], chain(taken, chunks)


def _unpacked(data: bytes, visit: Visit, met: Streams) -> Iterator[tuple[bytes, int]]:
    """Bytes with all compression unwrapped, and its depth; nothing if there is none.

    One piece, as long as the document's room lasts, then overlapping windows.
    """
    chunks, head, depth, heads = iter([data]), data[:HEAD], 0, set()
    while head.startswith(MAGIC) and head not in heads:
        heads.add(head)
        inner, chunks = _peek(_inflate(_cut(chunks), met))
        if inner == head:  # no stream
            break
        head, depth = inner, depth + 1
    if not depth:
        return
    size, held = max(visit.room, WINDOW), bytearray()
    for chunk in chunks:
        held += chunk
        while len(held) > size:
            met.broken = True
            visit.room = 0
            yield bytes(held[:size]), depth
            del held[: size - OVERLAP]
            size = WINDOW
    visit.room = max(visit.room - len(held), 0)
    if held:
        yield bytes(held), depth


def _stream_end(data: bytes) -> int:
    """Where the compressed streams at the start of the bytes end; 0 if there are none."""
    end = 0
    while data.startswith(MAGIC, end):
        engine, at, made = _engine(data[end : end + 4]), end, 0
        while not engine.eof:
            try:
                made += len(engine.decompress(data[at : at + CHUNK]))
            except (zlib.error, zstandard.ZstdError):
                return end
            at = min(at + CHUNK, len(data))
            if at == len(data) and not engine.eof:
                return at if data[end : end + 1] != b"x" or made > ENOUGH else end
        end = at - len(engine.unused_data)
    return end


def _spelled(text: str, via: str) -> list[Callable[[int], bytes]]:
    """The ways decoded escapes may stand for bytes: each gives the bytes of the first n characters."""
    def encoder(change: Callable[[str], str], codec: str, errors: str) -> Callable[[int], bytes]:
        def encode(n: int) -> bytes:
            own = change(text[:n])
            try:
                return own.encode(codec, errors)
            except UnicodeEncodeError as e:  # no byte: the stream ends before it
                return own[:e.start].encode(codec, errors)

        return encode

    changes: list[Callable[[str], str]] = [lambda x: x]
    if via == "url" and "+" in text:
        changes.insert(0, lambda x: x.replace("+", " "))
    if via == "unicode" and "\\" in text:
        changes.insert(0, lambda x: LITERAL.sub(lambda m: LITERALS.get(m[1], m[1]), x))
    return [encoder(c, *how) for c in changes for how in (("utf-8", "surrogateescape"), ("latin-1", "strict"))]


def _packed(layer: Layer) -> Iterator[tuple[bytes, int, int]]:
    """Compressed bytes that the escapes of a layer stood for, and their place in it."""
    last = 0
    for m in PACKED.finditer(layer.text):
        if m.start() < last:
            continue
        rest = layer.text[m.start():]
        for encode in _spelled(rest, layer.via):
            data = encode(len(rest))
            if data.startswith(MAGIC) and (end := _stream_end(data)):
                n = bisect.bisect_left(range(len(rest)), end, key=lambda k: len(encode(k)))
                last = m.start() + n
                yield data[:end], m.start(), last
                break


def _runs(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """Base64 runs with their places; those over line breaks first, marked by True.

    Lines of a wrapped run are equally long, but for the first, which may follow other text,
    and the last. A run is also tried from each line where the length changes, and the whole
    chain of lines is tried as it is.
    """
    for m in WRAPPED.finditer(text):
        lines = [p.span() for p in PIECE.finditer(text, m.start(), m.end())]
        sizes = [b - a for a, b in lines]
        chains = {(0, len(lines))}
        for i in range(len(lines) - 1):
            if i and sizes[i] == sizes[i - 1]:
                continue
            width, j = max(sizes[i], sizes[i + 1]), i + 1
            while j < len(lines) and sizes[j] == width:
                j += 1
            chains.add((i, min(j + 1, len(lines)) if j == len(lines) or sizes[j] < width else j))
        for i, j in sorted(chains, key=lambda c: (c[0] - c[1], c)):
            run = "".join(text[a:b] for a, b in lines[i:j])
            if len(run) >= 16 and j - i > 1:
                yield run, lines[i][0], m.end() if j == len(lines) else lines[j - 1][1], True
    for m in BASE64.finditer(text):
        yield m[0].rstrip("="), m.start(), m.end(), False


def _blobs(layer: Layer, visit: Visit) -> Iterator[Layer]:
    """Layers for each base64 run and for compressed bytes behind escapes."""
    read: list[tuple[int, int]] = []  # wrapped runs that are one compressed stream or text

    def layers(data: bytes, a: int, b: int, via: str, depth: int) -> Iterator[Layer]:
        for text in _views(data):
            yield Layer(text, layer, (via + ">inflate" * depth).strip(">"),
                        layer.depth + bool(via) + depth, [0], [(a, b)], [False])

    def inflated(data: bytes, a: int, b: int, via: str, met: Streams) -> Iterator[Layer]:
        for inner, depth in _unpacked(data, visit, met):
            yield from layers(inner, a, b, via, depth)
        if met.broken:
            visit.unread.append(Layer("", layer, "", 0, [0], [(a, b)], [False]).original(0, 1))

    for run, a, b, wrapped in _runs(layer.text):
        i = bisect.bisect_right(read, (a, len(layer.text))) - 1
        if i >= 0 and b <= read[i][1]:
            continue
        starts = [0, *(m.start() for m in AFTER.finditer(run))]
        run = run.translate({45: 43, 95: 47})
        # A start's bytes are a part of those from the first start of the same remainder.
        phases: dict[int, tuple[int, bytes]] = {}
        streamed = False
        for at in starts:
            if at % 4 not in phases:
                part = run[at:]
                part = part[: len(part) - (len(part) % 4 == 1)]
                phases[at % 4] = at, base64.b64decode(part + "=" * (-len(part) % 4))
            first, data = phases[at % 4]
            offset = (at - first) // 4 * 3
            if data.startswith(MAGIC, offset):
                met = Streams()
                yield from inflated(data[offset:], a if wrapped else a + at, b, "base64", met)
                if met.ends and not at:
                    streamed = True
                    break
        if streamed:
            if wrapped:
                bisect.insort(read, (a, b))
            continue
        for first, data in phases.values():
            yield from layers(data, a if wrapped else a + first, b, "base64", 0)
        if wrapped and _plain(phases[0][1]):
            bisect.insort(read, (a, b))
    if layer.via in ("url", "unicode"):
        for data, start, end in _packed(layer):
            yield from inflated(data, start, end, "", Streams())


def _plain(data: bytes) -> bool:
    try:
        return b"\0" not in data and bool(data.decode("utf-8"))
    except UnicodeDecodeError:
        return False


def _children(layer: Layer, visit: Visit) -> Iterator[Layer]:
    if "%" in layer.text and (new := _rewritten(layer, PERCENT, _percent, "url")):
        yield new
    if ("\\" in layer.text or "&#" in layer.text) and (
        new := _rewritten(layer, UNICODE, _unicode, "unicode")
    ):
        yield new
    yield from _blobs(layer, visit)


def _layers(text: str, visit: Visit) -> Iterator[Layer]:
    """The text and its layers, depth first, so that only a layer's ancestors are held."""
    root = Layer(text)
    yield root
    seen: set[bytes] = set()
    stack = [_children(root, visit)]
    while stack:
        new = next(stack[-1], None)
        if new is None:
            stack.pop()
            continue
        # The same text in two places is two findings, so its place is in the mark.
        mark = xxhash.xxh3_128_digest(new.text.encode("utf-8", "surrogatepass"))
        mark += repr(new.original(0, len(new.text))).encode()
        if new.text and mark not in seen:
            seen.add(mark)
            yield new
            stack.append(_children(new, visit))


def unwrap(text: str, max_decoded: int = MAX_DECODED) -> tuple[list[Layer], bool]:
    """All layers of a text, itself first, and whether all of them were visited whole."""
    visit = Visit(max_decoded)
    layers = list(_layers(text, visit))
    return layers, not visit.unread


def _find(text: str, max_decoded: int) -> tuple[list[tuple], int, list[tuple[int, int]]]:
    found: dict[tuple, tuple] = {}
    visit, n = Visit(max_decoded), 0
    for layer in _layers(text, visit):
        n += 1
        for a, k, b in base_spans(layer.text):
            start, end = layer.original(a, b)
            known = found.get((start, k, end))
            if known is None or layer.depth < known[0]:
                found[start, k, end] = layer.depth, layer.path(), layer.text[a:b]
    return [(*key, *found[key]) for key in sorted(found)], n, visit.unread


def find_secrets(text: str, max_decoded: int = MAX_DECODED) -> tuple[list[tuple], int, bool]:
    """(start, kind number, end, depth, via, value) of all findings by place, the number of
    layers, and whether all layers were visited whole. One place and kind is one finding."""
    found, n, unread = _find(text, max_decoded)
    return found, n, not unread


def scan_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 max_decoded: int = MAX_DECODED) -> DataFrame:
    """Secrets of every whole text, one row per row of `docs`.

    `findings` are sorted by start, kind (assign, access, hex) and end; `depth` 0 marks the
    plain patterns, a larger one a finding in a decoded layer, with `via` naming the steps.
    Places are code points of the original text, end exclusive. `whole` is false if a
    compressed stream has no end, or if more than `max_decoded` bytes of one document inflate
    (a decompression bomb): what is beyond is read in windows of 1 MB that overlap by 64 KB, so
    that only longer findings and encodings can be cut. Null and empty texts have
    no findings. Ids may be null or repeat; other columns are not looked at.
    """

    def make():
        def scan(batch: pa.RecordBatch) -> dict:
            rows, layers, whole = [], [], []
            for text in batch.column(1).to_pylist():
                found, n, all_of_it = find_secrets(text or "", max_decoded)
                rows.append([
                    {"kind": KINDS[k], "start": a, "end": b, "depth": d, "via": v, "value": x}
                    for a, k, b, d, v, x in found
                ])
                layers.append(n)
                whole.append(all_of_it)
            return {"id": batch.column(0), "findings": pa.array(rows, pa.list_(FINDING_TYPE)),
                    "n_layers": pa.array(layers, pa.int32()), "whole": whole}

        return scan

    kind = docs.schema[id_column].dataType.simpleString()
    plain = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return over_texts(
        plain, "text", f"id: {kind}, findings: array<{FINDING}>, n_layers: int, whole: boolean", make
    ).withColumnRenamed("id", id_column)


def joined_spans(findings: Column) -> Column:
    """kind:start:end of findings, comma-joined."""
    return F.array_join(
        F.transform(findings, lambda f: F.concat_ws(
            ":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ","
    )


def digest(scanned: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts and hash of the plain findings, and all spans as one string."""
    base = F.filter("findings", lambda f: f["depth"] == 0)

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda f: f["kind"] == kind)).cast("long")

    return scanned.select(
        id_column,
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(joined_spans(base), 256).alias("base_sha256"),
        joined_spans(F.col("findings")).alias("spans"),
        "n_layers",
        "whole",
    )


def redact(text: str, max_decoded: int = MAX_DECODED) -> str:
    """The text with every finding, overlapping ones merged, replaced by a mark of its kind, and
    what could not be read whole by <UNREAD>."""
    found, _, unread = _find(text, max_decoded)
    places = [(a, k, b) for a, k, b, *_ in found] + [(a, -1, b) for a, b in unread]
    parts, at = [], 0
    for a, k, b in sorted(places):
        if b <= at:
            continue
        if a >= at:
            parts += [text[at:a], "<UNREAD>" if k < 0 else f"<{KINDS[k].upper()}>"]
        at = b
    return "".join(parts) + text[at:]


def redact_documents(docs: DataFrame, text_column: str = "text",
                     length_column: str = "n_chars") -> DataFrame:
    """All rows of `docs`, secrets in the text replaced by marks; null texts stay null.

    `length_column`, if there is one, becomes the new text's length where the text changed.
    """
    name = free_name(docs, "_redacted")

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            texts = batch.column(batch.schema.get_field_index(text_column)).to_pylist()
            return {name: pa.array([t and redact(t) for t in texts], pa.string())}

        return run

    out = over_texts(docs, text_column, f"`{name}` string", make, keep=True)
    same = F.col(name).eqNullSafe(F.col(text_column))
    return out.select(*[
        F.col(name).alias(c) if c == text_column
        else F.when(same, F.col(c)).otherwise(F.length(name)).alias(c) if c == length_column
        else F.col(c)
        for c in docs.columns
    ])
