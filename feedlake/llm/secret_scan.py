"""Secret scan: base patterns over the text, then over everything that is encoded in it.

Encoded parts are unwrapped with a worklist of layers. The text is the first layer; URL escapes,
Unicode escapes, base64 runs and zlib/gzip streams found in a layer give new layers, until no new
layer appears. Every character of a text with escapes undone knows the span of the original that it came
from; all that a base64 run encodes, however deep, has the span of the run. Cycles end because a layer
is not opened again at the same place, nor within the same run; equal runs are opened once, and what
they hide is reported at each of their places. All searches take time linear in the text.

What a compressed run may unpack to has a limit (``FREE_BYTES`` and ``BYTES_PER_BYTE``), as a few hundred bytes can ask for
terabytes; a run that reaches it is reported as unopened, and masked whole.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import map_lists, map_whole, with_column

KINDS = ("assign", "access", "hex")
#: What stands for an encoded run that asks for more than its budget.
UNOPENED = "unopened"
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_LONG_HEX = re.compile(r"[0-9a-f]{16}")
_KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")

#: An escape of an escape of an escape, however deep, is undone at once: its layers differ in nothing else.
_URL = re.compile(r"(%25(?:25)+)|(?:%(?!2525)[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|\\U([0-9A-Fa-f]{8})")
_DEEP_ESCAPE = re.compile(r"\\(?:u005[cC]|x5[cC]){2,}")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
#: Base64 over two or more lines of any width; the first may begin within a line, the last may be closed by a mark.
#: Runs are tried at their beginning only and nothing is given back, so the search is linear.
_WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{4,}+(?<!---)"
    r"""(?:(?<!=)[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++={0,2}+(?=[ \t]*+(?:[\r\n"'`<),;\]}]|\Z)))++"""
)
_LINE = re.compile(r"[A-Za-z0-9+/_=-]+")
#: From this width on a line and a shorter one after it are taken for one code.
FULL_WIDTH = 64
_STREAM = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]")
#: Where an escaped gzip or zlib stream begins, and the bytes that follow, escaped or as they are.
_URL_STREAM = re.compile(r"(?:%1[fF]%8[bB]|(?:x|%78)(?:%01|%5[eE]|\^|%9[cC]|%[dD][aA]))(?:%[0-9A-Fa-f]{2}|[!-$&-~])*")
_ESCAPED_STREAM = re.compile(
    r"(?:\\(?:x|u00)1[fF]\\(?:x|u00)8[bB]|(?:x|\\(?:x|u00)78)(?:\^|\\(?:x|u00)(?:01|5[eE]|9[cC]|[dD][aA])))"
    r"""(?:\\(?:x|u00)[0-9A-Fa-f]{2}|\\[abfnrtv0\\'"]|[ -\[\]-~])*"""
)
_ESCAPED_BYTE = re.compile(r"%([0-9A-Fa-f]{2})|\\(?:x|u00)([0-9A-Fa-f]{2})|\\(.)|(.)")
_SHORT = dict(zip("abfnrtv0", b"\a\b\f\n\r\t\v\0"))
#: A compressed stream is scanned whole, in windows of about so many bytes, so that a small one cannot fill a task's memory.
WINDOW = 1 << 20
#: A window grows to so many bytes where an encoded run is not at its end; a longer run or line is scanned in parts that overlap.
HELD, OVERLAP = 4 << 20, 1 << 16
#: What one encoded run may unpack to: so many bytes, and so many more for each of its own.
FREE_BYTES, BYTES_PER_BYTE = 32 << 20, 64

Span = tuple[int, str, int]  # start, kind, end


@dataclass(frozen=True)
class Layer:
    """Decoded text; ``starts`` and ``ends`` give each character's span in the original (None: the text itself)."""

    text: str
    starts: array | None = None
    ends: array | None = None

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        return min(self.starts[start:end]), max(self.ends[start:end])

    def key(self) -> tuple[bytes, bytes]:
        """Equal only for the same text at the same places."""
        return _digest(self.text), b"" if self.starts is None else xxhash.xxh3_128_digest(self.starts.tobytes() + self.ends.tobytes())


def matches(text: str) -> Iterator[tuple[str, int, int]]:
    """Base findings: per kind leftmost and without overlap, those that fail the length test dropped."""
    low = text.lower()
    if any(word in low for word in _KEYWORDS):
        yield from (("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12)
    if "AKIA" in text:
        yield from (("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18)
    if _LONG_HEX.search(text):
        yield from (("hex", m.start(), m.end()) for m in _HEX.finditer(text) if m.end() - m.start() >= 16)


Part = tuple[int, int, str]  # start, end, decoded


def _replaced(text: str, found: list[Part]) -> str:
    """``text`` with each part replaced by what it encodes."""
    parts, at = [], 0
    for start, end, decoded in found:
        parts += [text[at:start], decoded]
        at = end
    return "".join(parts) + text[at:]


def _substituted(layer: Layer, found: list[Part]) -> Layer:
    """``layer`` with each part replaced; decoded characters map to the whole replaced span."""
    starts, ends, at = array("q"), array("q"), 0
    own = layer.starts is None

    def copy(a: int, b: int) -> None:
        starts.extend(range(a, b) if own else layer.starts[a:b])
        ends.extend(range(a + 1, b + 1) if own else layer.ends[a:b])

    for start, end, decoded in found:
        copy(at, start)
        low, high = layer.span(start, end)
        starts.extend([low] * len(decoded))
        ends.extend([high] * len(decoded))
        at = end
    copy(at, len(layer.text))
    return Layer(_replaced(layer.text, found), starts, ends)


def _url_parts(text: str) -> list[Part]:
    found = []
    for m in _URL.finditer(text) if "%" in text else ():
        if m[1]:
            found.append((m.start(), m.end(), "%25"))
            continue
        run = bytes.fromhex(m[0].replace("%", ""))
        if not any(byte >= 128 for byte in run):  # each escape is one character with a span of its own
            found += [(m.start() + 3 * i, m.start() + 3 * i + 3, chr(byte)) for i, byte in enumerate(run)]
        else:
            found.append((m.start(), m.end(), run.decode("utf-8", "replace")))
    return found


def _escape_parts(text: str) -> list[Part]:
    found = []
    if "\\" not in text:
        return found
    if deep := [(m.start(), m.end(), r"\x5c") for m in _DEEP_ESCAPE.finditer(text)]:
        return deep  # the other escapes are undone in the next layer
    for m in _ESCAPE.finditer(text):
        code = int(m[1] or m[2] or m[3], 16)
        if code <= 0x10FFFF and not 0xD800 <= code <= 0xDFFF:
            found.append((m.start(), m.end(), chr(code)))
    return found


class Budget:
    """The bytes that one encoded run may still unpack to."""

    def __init__(self, size: int):
        self.left = FREE_BYTES + BYTES_PER_BYTE * size

    def took(self, n: int) -> bool:
        self.left -= n
        return self.left >= 0


def _inflated(chunks: Iterator[bytes], budget: Budget) -> Iterator[bytes]:
    """The content of gzip members or a zlib stream, in parts of at most WINDOW bytes, until the budget ends."""
    stream = zlib.decompressobj(47)
    for chunk in chunks:
        while chunk and budget.left >= 0:
            part = stream.decompress(chunk, WINDOW)
            if not budget.took(len(part)):
                return
            yield part
            chunk = stream.unused_data or stream.unconsumed_tail
            if stream.eof and chunk:
                stream = zlib.decompressobj(47)
    if budget.left >= 0:
        yield stream.flush()


def _unpacked(data: memoryview, budget: Budget) -> Iterator[bytes] | None:
    """The content of a compressed stream, however often it was compressed; None if it is not compressed."""
    chunks, head, opened = (data[k : k + OVERLAP] for k in range(0, len(data), OVERLAP)), bytes(data[:2]), False
    while head[:2] == b"\x1f\x8b" or head[:1] == b"\x78":
        try:
            inner = _inflated(chunks if not opened else chain([head], chunks), budget)
            first = next((part for part in inner if part), b"")
        except zlib.error:
            break
        chunks, head, opened = inner, first, True
    return chain([head], chunks) if opened else None


_WRAP_END = re.compile(rb"[A-Za-z0-9+/_-][ \t]*\r?\n\Z")
_WRAP_NEXT = re.compile(rb"""[ \t]*+[A-Za-z0-9+/_-]*+={0,2}+[ \t]*+(?:[\r\n"'`<),;\]}]|\Z)""")


def _safe_cut(held: bytearray) -> int:
    """The last line end that no base64 run goes over; 0 if there is none."""
    cut = held.rfind(b"\n") + 1
    while cut and _WRAP_END.search(held, max(0, cut - 200), cut) and _WRAP_NEXT.match(held, cut):
        cut = held.rfind(b"\n", 0, cut - 1) + 1
    return cut


def _line_windows(parts: Iterator[bytes]) -> Iterator[bytes]:
    """The bytes of a stream in windows that end with a line within no wrapped run: no other pattern or code reaches across lines.

    A damaged stream ends where it is damaged. Where HELD bytes have no such end, the next window repeats their last OVERLAP bytes.
    """
    held = bytearray()
    try:
        for part in parts:
            held += part
            if len(held) >= WINDOW and (cut := _safe_cut(held)):
                yield bytes(held[:cut])
                del held[:cut]
            elif len(held) >= HELD:
                yield bytes(held)
                del held[:-OVERLAP]
    except zlib.error:
        pass
    if held:
        yield bytes(held)


def _texts(data: bytes, budget: Budget) -> Iterator[str]:
    """The windows of each compressed stream that begins anywhere in some bytes, then the bytes as text, printable or not."""
    view = memoryview(data)
    for at in sorted({0, *(m.start() for m in _STREAM.finditer(data))}):
        parts = _unpacked(view[at:], budget)
        if parts is not None:
            yield from (window.decode("utf-8", "replace") for window in _line_windows(parts))
    yield data.decode("utf-8", "replace")


def _decoded(run: str, budget: Budget) -> Iterator[str]:
    """The texts that a base64 run encodes, over line ends and in all four alignments: other characters may stand before it."""
    run = "".join(run.split()).partition("=")[0].replace("-", "+").replace("_", "/")
    for skip in range(4):
        part = run[skip:]
        if len(part) % 4 == 1:
            part = part[:-1]
        yield from _texts(base64.b64decode(part + "=" * (-len(part) % 4)), budget)


def _unescaped(run: str, budget: Budget) -> Iterator[str]:
    """The texts of an escaped stream."""
    data = bytearray()
    for m in _ESCAPED_BYTE.finditer(run):
        code = m[1] or m[2]
        data.append(int(code, 16) if code else _SHORT.get(m[3], ord(m[3])) if m[3] else ord(m[4]))
    yield from _texts(bytes(data), budget)


def _runs(text: str) -> Iterator[tuple[int, int, Callable[[str, Budget], Iterator[str]]]]:
    """Start, end and decoder of all that is encoded as bytes in a text."""
    for pattern, decoder in ((_BASE64, _decoded), (_WRAPPED, _decoded), (_URL_STREAM, _unescaped), (_ESCAPED_STREAM, _unescaped)):
        if (pattern is _URL_STREAM and "%" not in text) or (pattern is _ESCAPED_STREAM and "\\" not in text):
            continue
        yield from ((m.start(), m.end(), decoder) for m in pattern.finditer(text))


def _wrapped(text: str, alone: Callable[[str], bool]) -> Iterator[tuple[int, int]]:
    """Start and end of what may be one code over several lines.

    Lines of one width and a shorter one after them are one code, with a first line that begins within a line. Other lines
    that follow each other are joined too, but not those that hide something ``alone``: they are codes of their own.
    """
    for m in _WRAPPED.finditer(text):
        lines = [line.span() for line in _LINE.finditer(text, m.start(), m.end())]
        width = [end - start for start, end in lines]
        inside = m.start() > 0 and text[text.rfind("\n", 0, m.start()) + 1 : m.start()].strip() != ""
        loose: list[tuple[int, int]] = []
        k = 0
        while k < len(lines):
            first = k + 1 if k == 0 and inside and len(lines) > 2 and width[1] == width[2] >= width[0] else k
            end = first + 1
            while end < len(lines) and width[end] == width[first]:
                end += 1
            sure = end - first > 1 or (width[first] >= FULL_WIDTH and end < len(lines) and width[end] < width[first])
            if sure:
                end += end < len(lines) and width[end] < width[first]
                yield lines[k][0], lines[end - 1][1]
                k = end
            elif not alone(text[slice(*lines[k])]):
                loose.append(lines[k])
                k += 1
                if k < len(lines):
                    continue
            else:
                k += 1
            if len(loose) > 1:
                yield loose[0][0], loose[-1][1]
            loose = []


def _opened(text: str, budget: Budget) -> Iterator[str]:
    """The texts that are encoded in one, each made when it is asked for."""
    for find in (_url_parts, _escape_parts):
        if found := find(text):
            yield _replaced(text, found)
    for start, end, decoder in _runs(text):
        yield from decoder(text[start:end], budget)


def _hidden(run: str, decoder: Callable[[str, Budget], Iterator[str]]) -> set[str]:
    """The kinds of findings in the texts of an encoded run and in all that they encode; their place is that of the run.

    UNOPENED is among them where the budget ended before the run did.
    """
    budget = Budget(len(run))
    kinds: set[str] = set()
    seen: set[bytes] = set()
    work = [decoder(run, budget)]  # depth first, so one window of a stream is held at a time
    while work and len(kinds) < len(KINDS):
        text = next(work[-1], None)
        if text is None:
            work.pop()
        elif (digest := _digest(text)) not in seen:
            seen.add(digest)
            kinds.update(kind for kind, _, _ in matches(text))
            work.append(_opened(text, budget))
    return kinds | {UNOPENED} if budget.left < 0 else kinds


def _digest(text: str) -> bytes:
    return xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))


def find_secrets(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans of a text, and the further spans of the layers encoded in it, both as (start, kind, end).

    A null text counts as empty. Spans are code points, ends exclusive, sorted by start, then kind.
    """
    base, more, _ = search_layers(text)
    return base, more


def search_layers(text: str | None) -> tuple[list[Span], list[Span], list[Span]]:
    """:func:`find_secrets`, and the encoded runs that were not opened to their end."""
    text = text or ""
    order = {kind: k for k, kind in enumerate(KINDS)}
    base = {(start, kind, end) for kind, start, end in matches(text)}
    more: set[Span] = set()
    hidden: dict[str, set[str]] = {}  # equal runs are opened once and found at each of their places

    def opened(run: str, decoder: Callable[[str, Budget], Iterator[str]]) -> set[str]:
        if (kinds := hidden.get(run)) is None:
            kinds = hidden[run] = _hidden(run, decoder)
        return kinds

    work = [Layer(text)]
    seen = {work[0].key()}
    while work:
        layer = work.pop()
        if layer.starts is not None:
            for kind, start, end in matches(layer.text):
                low, high = layer.span(start, end)
                more.add((low, kind, high))
        runs = ((start, end, decoder) for start, end, decoder in _runs(layer.text) if "\n" not in layer.text[start:end])
        wrapped = ((start, end, _decoded) for start, end in _wrapped(layer.text, lambda line: bool(opened(line, _decoded))))
        for start, end, decoder in chain(runs, wrapped):
            if kinds := opened(layer.text[start:end], decoder):
                low, high = layer.span(start, end)
                more.update((low, kind, high) for kind in kinds)
        for find in (_url_parts, _escape_parts):
            if found := find(layer.text):
                inner = _substituted(layer, found)
                if (key := inner.key()) not in seen:
                    seen.add(key)
                    work.append(inner)
    key = lambda span: (span[0], order[span[1]], span[2])
    unopened = {span for span in more if span[1] == UNOPENED}
    return sorted(base, key=key), sorted(more - base - unopened, key=key), sorted(unopened)


def joined(spans: list[Span]) -> str:
    """Spans as ``kind:start:end``, comma-joined."""
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """The findings of every document: doc_id, base and further spans and unopened runs as arrays, and the spans as texts.

    One narrow pass, no shuffle. Null text counts as empty; a null or repeated doc_id keeps its own row; other
    columns of ``docs`` are not read. An empty table gives an empty result.
    """

    def make():
        def step(rows):
            found = [search_layers(text) for text in rows["text"]]
            return {
                "doc_id": rows["doc_id"],
                "base": [[{"start": s, "kind": k, "end": e} for s, k, e in base] for base, _, _ in found],
                "decoded": [[{"start": s, "kind": k, "end": e} for s, k, e in more] for _, more, _ in found],
                "unopened": [[{"start": s, "kind": k, "end": e} for s, k, e in left] for _, _, left in found],
                "base_text": [joined(base) for base, _, _ in found],
                "all_text": [joined(sorted(base + more, key=lambda x: (x[0], KINDS.index(x[1]), x[2]))) for base, more, _ in found],
            }

        return step

    span = "array<struct<start:int,kind:string,end:int>>"
    return map_lists(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make,
        f"doc_id long, base {span}, decoded {span}, unopened {span}, base_text string, all_text string",
    )


def masked(text: str | None) -> str | None:
    """The text with every finding and unopened run replaced by ``[kind]``; overlapping ones become one."""
    base, more, unopened = search_layers(text)
    found = sorted(base + more + unopened)
    if not found:
        return text
    parts, at = [], 0
    for start, kind, end in found:
        if start >= at:
            parts += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(parts) + text[at:]


def mask_secrets(docs: DataFrame) -> DataFrame:
    """All documents, secrets in their texts replaced by ``[kind]`` and ``n_chars`` (if there) counted anew.

    Each row is judged by its own text, whatever its doc_id; null texts and all other columns stay; an empty table stays empty.
    """
    sized = "n_chars" in docs.columns

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            old = batch.column(batch.schema.get_field_index("text")).to_pylist()
            new = [masked(text) for text in old]
            batch = with_column(batch, "text", new)
            if sized:
                chars = batch.column(batch.schema.get_field_index("n_chars")).to_pylist()
                batch = with_column(batch, "n_chars", [c if a == b else len(b) for a, b, c in zip(old, new, chars)])
            return batch

        return step

    return map_whole(docs, make)


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts per kind, the digest of the base spans, and all spans as text, one row per document."""
    found = scan_secrets(docs)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(kind) for kind in KINDS],
        F.sha2(F.col("base_text").cast("binary"), 256).alias("base_sha256"), F.col("all_text").alias("spans"),
        F.size("unopened").cast("long").alias("n_unopened"),
    )
