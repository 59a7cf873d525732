"""Media columns for GIF: code streams, palettes, disposal, transparency, timed frames.

``read_gif`` parses the blocks and decodes each image's LZW codes,
``timed_frames`` lays the images over a canvas by palette, transparency and
disposal, and gives every frame its start, duration and colour histogram.
``write_gif`` stores 8-bit samples losslessly as the indexes of full frames with
a grey palette.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slim, table

SIDE = 24
GREY = bytes(v for k in range(256) for v in (k, k, k))
_MOST = 4096  # codes have 12 bits at most
BINS = 4  # of each channel
TOGETHER = 1 << 18  # bytes of texts that are encoded in one go


class GifError(ValueError):
    """The bytes are no GIF that can be decoded."""


def _widths(least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Width, first bit and bit mask of the k-th code after a clear, for a minimum code size."""
    count = 3 * _MOST
    widths = np.minimum(12, np.array([((1 << least) + 1 + k).bit_length() for k in range(count)]))
    return widths, np.concatenate([[0], np.cumsum(widths)]), np.arange(16)[None, :] < widths[:, None]


_LAYOUT = {least: _widths(least) for least in range(2, 9)}
_FULL_MASKS = {least: (1 << _LAYOUT[least][0]).astype(np.uint32) - 1 for least in _LAYOUT}


def _runs(data: bytes, least: int) -> list[np.ndarray]:
    """The codes of a stream, cut at its clear codes, until the stop code or the end."""
    clear, stop = 1 << least, (1 << least) + 1
    first, masks = _LAYOUT[least][1], _FULL_MASKS[least]
    raw = np.frombuffer(data + b"\0\0\0\0", np.uint8).astype(np.uint32)
    bits, at, runs = 8 * len(data), 0, []
    while at + least + 1 <= bits:
        room = min(int(np.searchsorted(first, bits - at, side="right")) - 1, len(masks))  # whole codes until the end, if none clears
        where = at + first[:room]
        byte = where >> 3
        codes = (raw[byte] | raw[byte + 1] << 8 | raw[byte + 2] << 16) >> (where & 7).astype(np.uint32) & masks[:room]
        special = np.flatnonzero((codes == clear) | (codes == stop))
        if not len(special):
            runs.append(codes)
            break
        n = int(special[0])
        runs.append(codes[:n])
        if codes[n] == stop:
            break
        at += int(first[n + 1])
    return [r for r in runs if len(r)]


def lzw_decode_many(streams: list[bytes], least: int, pixels: list[int]) -> list[bytes | GifError]:
    """The palette indexes of several code streams, or what is wrong with one.

    A table entry is the string of one code and the first colour of the next, so
    a code's string is found by following codes back: first colours and lengths
    by pointer doubling, the colours from the last to the first.
    """
    if least not in _LAYOUT:
        return [GifError(f"minimum code size {least}")] * len(streams)
    clear = 1 << least
    runs, owner = [], []
    for k, data in enumerate(streams):
        mine = _runs(data, least)
        runs += mine
        owner += [k] * len(mine)
    if not runs:
        return [GifError(f"0 of {n} pixels") for n in pixels]
    sizes = np.array([len(r) for r in runs])
    codes = np.concatenate(runs).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    base, own = np.repeat(starts, sizes), np.arange(len(codes))
    literal, entry = codes < clear, codes - (clear + 2)
    bad = ~literal & ((entry < 0) | (entry >= own - base))
    wrong = set(np.repeat(owner, sizes)[bad].tolist())
    codes[bad], literal[bad] = 0, True
    parent = np.where(literal, own, base + entry)
    jump, depth = parent.copy(), (~literal).astype(np.int64)
    while not literal[jump].all():
        depth, jump = depth + depth[jump], jump[jump]
    first = codes[jump]
    last = np.where(literal, codes, first[np.where(literal, own, base + entry + 1)]).astype(np.uint8)
    ends = np.cumsum(depth + 1)
    out = np.empty(int(ends[-1]), np.uint8)
    here, at = own, ends - 1
    while len(here):
        out[at] = last[here]
        more = ~literal[here]
        here, at = parent[here[more]], at[more] - 1
    until = np.zeros(len(streams), np.int64)
    until[owner] = ends[starts + sizes - 1]  # of a stream's runs the last one counts
    until = np.maximum.accumulate(until)
    begin = np.concatenate([[0], until[:-1]])
    result: list[bytes | GifError] = []
    for k, n in enumerate(pixels):
        if k in wrong:
            result.append(GifError("a code before its definition"))
        elif until[k] - begin[k] < n:
            result.append(GifError(f"{until[k] - begin[k]} of {n} pixels"))
        else:
            result.append(out[begin[k] : begin[k] + n].tobytes())
    return result


def lzw_codes(data: bytes, least: int = 8) -> list[list[int]]:
    """The codes of palette indexes, a list for each table; a table is full before the next begins."""
    start = (1 << least) + 2
    runs: list[list[int]] = []
    out: list[int] = []
    known: dict[int, int] = {}
    free, prefix, at = start, data[0], 1
    while at < len(data):
        if free >= _MOST:
            runs.append([*out, prefix])
            out, known, free, prefix, at = [], {}, start, data[at], at + 1
            continue
        get, append = known.get, out.append
        sure = data[at : at + _MOST - free]  # no more than these fill the table
        at += len(sure)
        for value in sure:
            key = prefix << 8 | value
            code = get(key)
            if code is None:
                append(prefix)
                known[key] = free
                free += 1
                prefix = value
            else:
                prefix = code
    return [*runs, [*out, prefix]]


def lzw_encode_many(pieces: list[bytes], least: int = 8) -> list[bytes]:
    """GIF code streams: a clear code, and one after each full table, the stop code last."""
    clear = 1 << least
    widths, first, _ = _LAYOUT[least]
    codes: list[int] = []
    sizes, lead, stream = [], [], []  # of a run: its codes, whether a clear code stands before it, its stream
    for k, data in enumerate(pieces):
        runs = lzw_codes(data, least)
        for i, run in enumerate(runs):
            codes += run
            codes.append(clear + (i == len(runs) - 1))
            sizes.append(len(run) + 1)
            lead.append(i == 0)
            stream.append(k)
    sizes, lead = np.array(sizes), np.array(lead)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    bits_of_run = first[sizes] + (least + 1) * lead
    total = np.bincount(stream, bits_of_run, len(pieces)).astype(np.int64)
    whole = (total + 7) // 8 * 8  # each stream begins at a byte
    begin = np.cumsum(whole) - whole
    run_begin = np.cumsum(bits_of_run) - bits_of_run
    run_begin += (begin - (np.cumsum(total) - total))[stream]
    bits = np.zeros(int(whole.sum()), np.uint8)
    bits[begin + least] = 1  # the first code of a stream is clear
    where = np.repeat(run_begin + (least + 1) * lead, sizes) + first[place]
    value, width = np.array(codes), widths[place]
    for b in range(12):
        if b > least:
            wide = width > b
            where, value, width = where[wide], value[wide], width[wide]
        bits[where + b] = value >> b & 1
    packed = np.packbits(bits, bitorder="little").tobytes()
    return [packed[a // 8 : (a + n) // 8] for a, n in zip(begin.tolist(), whole.tolist(), strict=True)]


@dataclass(frozen=True)
class Image:
    left: int
    top: int
    width: int
    height: int
    palette: bytes
    indexes: bytes
    delay_ms: int = 100
    disposal: int = 0
    transparent: int | None = None


@dataclass(frozen=True)
class Gif:
    width: int
    height: int
    images: list[Image]


@dataclass(frozen=True)
class Frame:
    start_ms: int
    duration_ms: int
    pixels: np.ndarray  # height, width, RGBA
    histogram: np.ndarray  # of opaque pixels: BINS**3 colours, red first


def _blocks(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while True:
        if at >= len(data):
            raise GifError("the data end within a block")
        n = data[at]
        if not n:
            return b"".join(parts), at + 1
        parts.append(data[at + 1 : at + 1 + n])
        at += 1 + n


def _rows(indexes: bytes, width: int, height: int) -> bytes:
    """Interlaced rows in order."""
    order = [*range(0, height, 8), *range(4, height, 8), *range(2, height, 4), *range(1, height, 2)]
    out = bytearray(len(indexes))
    for k, row in enumerate(order):
        out[row * width : (row + 1) * width] = indexes[k * width : (k + 1) * width]
    return bytes(out)


def read_gif(data: bytes) -> Gif:
    """Parses a GIF87a or GIF89a file; raises ``GifError`` where it is none or is cut short."""
    gif = read_gifs([data])[0]
    if isinstance(gif, GifError):
        raise gif
    return gif


def _parse(data: bytes) -> tuple[int, int, list[tuple]]:
    """Size, and of each image its place, flags, palette, control values, minimum code size and code stream."""
    try:
        if data[:6] not in (b"GIF87a", b"GIF89a"):
            raise GifError("no GIF signature")
        width, height, packed = struct.unpack_from("<HHB", data, 6)
        at, shared = 13, b""
        if packed & 0x80:
            shared = data[at : at + 3 * (2 << (packed & 7))]
            at += len(shared)
        images, control = [], (0, 0, None)
        while data[at] != 0x3B:
            kind, at = data[at], at + 1
            if kind == 0x21:
                label = data[at]
                body, at = _blocks(data, at + 1)
                if label == 0xF9:
                    flags, delay, clear = struct.unpack_from("<BHB", body)
                    control = (delay * 10, flags >> 2 & 7, clear if flags & 1 else None)
            elif kind == 0x2C:
                *place, flags = struct.unpack_from("<HHHHB", data, at)
                at += 9
                palette = shared
                if flags & 0x80:
                    palette = data[at : at + 3 * (2 << (flags & 7))]
                    at += len(palette)
                least = data[at]
                codes, at = _blocks(data, at + 1)
                images.append((place, bool(flags & 0x40), palette, control, least, codes))
                control = (0, 0, None)
            else:
                raise GifError(f"block {kind}")
    except (IndexError, struct.error) as e:
        raise GifError(f"cut short: {e}") from None
    return width, height, images


def read_gifs(files: list[bytes]) -> list[Gif | GifError]:
    """Several files at once: their code streams are decoded together."""
    parsed: list = []
    streams: dict[int, list[tuple[int, int, bytes, int]]] = {}
    for k, data in enumerate(files):
        try:
            parsed.append(_parse(data))
        except GifError as e:
            parsed.append(e)
            continue
        for i, (place, _, _, _, least, codes) in enumerate(parsed[k][2]):
            streams.setdefault(least, []).append((k, i, codes, place[2] * place[3]))
    indexes: dict[tuple[int, int], bytes | GifError] = {}
    for least, those in streams.items():
        for (k, i, _, _), got in zip(those, lzw_decode_many([x[2] for x in those], least, [x[3] for x in those]), strict=True):
            indexes[k, i] = got
    out: list[Gif | GifError] = []
    for k, p in enumerate(parsed):
        if isinstance(p, GifError):
            out.append(p)
            continue
        images = []
        for i, (place, interlaced, palette, control, _, _) in enumerate(p[2]):
            got = indexes[k, i]
            if isinstance(got, GifError):
                out.append(got)
                break
            images.append(Image(*place, palette, _rows(got, place[2], place[3]) if interlaced else got, *control))
        else:
            out.append(Gif(p[0], p[1], images))
    return out


def _colours(palette: bytes) -> np.ndarray:
    rgba = np.zeros((256, 4), np.uint8)
    rgb = np.frombuffer(palette, np.uint8).reshape(-1, 3)
    rgba[: len(rgb), :3], rgba[:, 3] = rgb, 255
    return rgba


def _bins(rgba: np.ndarray) -> np.ndarray:
    part = (rgba[..., :3] // (256 // BINS)).astype(np.intp)
    return (part[..., 0] * BINS + part[..., 1]) * BINS + part[..., 2]


def timed_frames(gif: Gif) -> list[Frame]:
    """What is shown after each image: palette and transparency applied, the one before disposed of."""
    images = gif.images
    starts = np.cumsum([0, *(i.delay_ms for i in images)]).tolist()
    if images and all((i.left, i.top, i.width, i.height) == (0, 0, gif.width, gif.height) and i.transparent is None and i.palette == images[0].palette for i in images):
        # every image covers the canvas: nothing before it shows
        rgba = _colours(images[0].palette)
        index = np.frombuffer(b"".join(i.indexes for i in images), np.uint8).reshape(len(images), -1)
        bins = _bins(rgba)[index] + np.arange(len(images))[:, None] * BINS**3
        found = np.bincount(bins.ravel(), minlength=len(images) * BINS**3).reshape(len(images), -1)
        pixels = rgba[index].reshape(len(images), gif.height, gif.width, 4)
        return [Frame(starts[k], i.delay_ms, pixels[k], found[k]) for k, i in enumerate(images)]
    canvas = np.zeros((gif.height, gif.width, 4), np.uint8)
    out = []
    for image, start in zip(images, starts, strict=False):
        before = canvas.copy() if image.disposal == 3 else None
        index = np.frombuffer(image.indexes, np.uint8).reshape(image.height, image.width)
        y, x = slice(image.top, image.top + image.height), slice(image.left, image.left + image.width)
        area = canvas[y, x]
        index = index[: area.shape[0], : area.shape[1]]
        drawn = _colours(image.palette)[index]
        canvas[y, x] = drawn if image.transparent is None else np.where((index != image.transparent)[..., None], drawn, area)
        shown = canvas.copy()
        out.append(Frame(start, image.delay_ms, shown, np.bincount(_bins(shown)[shown[..., 3] > 0], minlength=BINS**3)))
        if image.disposal == 2:
            canvas[y, x] = 0
        elif image.disposal == 3:
            canvas = before
    return out


def write_gifs(payloads: list[bytes], side: int = SIDE, delay_ms: int = 100) -> list[bytes]:
    """A file for each payload: full frames of ``side`` by ``side`` samples, of whose size a payload is a positive multiple."""
    size = side * side
    if any(not p or len(p) % size for p in payloads):
        raise ValueError("a payload must be a positive multiple of a frame's size")
    head = b"GIF89a" + struct.pack("<HHBBB", side, side, 0xF7, 0, 0) + GREY
    each = b"\x21\xf9\x04" + struct.pack("<BHB", 1 << 2, delay_ms // 10, 0) + b"\0\x2c" + struct.pack("<HHHHB", 0, 0, side, side, 0) + b"\x08"
    streams = iter(lzw_encode_many([p[k : k + size] for p in payloads for k in range(0, len(p), size)]))
    out = []
    for p in payloads:
        parts = [head]
        for _ in range(len(p) // size):
            codes = next(streams)
            parts.append(each)
            parts += [bytes([len(b)]) + b for b in (codes[i : i + 255] for i in range(0, len(codes), 255))]
            parts.append(b"\0")
        out.append(b"".join([*parts, b"\x3b"]))
    return out


def padded(data: bytes, multiple: int = SIDE * SIDE) -> bytes:
    return data + b"\xff" * (max(1, -(-len(data) // multiple)) * multiple - len(data))


_FRAMES = pa.schema([("media_id", pa.int64()), ("frame", pa.int32()), ("start_ms", pa.int64()), ("duration_ms", pa.int64()), ("width", pa.int32()), ("height", pa.int32()), ("rgba", pa.binary()), ("histogram", pa.list_(pa.int64())), ("error", pa.string())])


def gif_frames(df: DataFrame, id_col: str = "media_id", data_col: str = "media") -> DataFrame:
    """A row for each frame of each GIF in a binary column, with its time, RGBA pixels and colour histogram.

    A null, empty or broken GIF gives one row with ``frame`` null and the reason in ``error``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for media, data in zip(batch.column("media_id").to_pylist(), batch.column("media").to_pylist(), strict=True):
                try:
                    gif = read_gif(data or b"")
                    rows = [(media, k, f.start_ms, f.duration_ms, gif.width, gif.height, f.pixels.tobytes(), f.histogram.tolist(), None) for k, f in enumerate(timed_frames(gif))]
                except GifError as e:
                    rows = [(media, *[None] * 7, str(e))]
                if rows:  # a batch for each GIF: frames of many are never held at once
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _FRAMES, strict=True)], schema=_FRAMES)

    return df.select(F.col(id_col).cast("long").alias("media_id"), F.col(data_col).alias("media")).mapInArrow(run, "media_id long, frame int, start_ms long, duration_ms long, width int, height int, rgba binary, histogram array<long>, error string")


_STORED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])


def stored_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's bytes stored as a GIF, read back and described; null is as empty.

    The payload columns come from the decoded and composed frames. ``feature`` is
    the number of frames, their total time and the colour histogram over all
    frames as ``colour=pixels`` for the colours that occur.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            at = 0
            while at < len(ids):
                datas: list[bytes] = []
                for text in texts[at:]:  # some texts at once, bounded by their bytes
                    if sum(map(len, datas)) >= TOGETHER:
                        break
                    datas.append((text or "").encode("utf-8", "surrogatepass"))
                media = write_gifs([padded(d) for d in datas])
                cols: dict[str, list] = {f.name: [] for f in _STORED}
                for doc, data, stored, gif in zip(ids[at : at + len(datas)], datas, media, read_gifs(media), strict=True):
                    frames = timed_frames(gif)
                    payload = b"".join(f.pixels[..., 0].tobytes() for f in frames)
                    colours = np.sum([f.histogram for f in frames], axis=0).tolist()
                    feature = f"frames={len(frames)};ms={sum(f.duration_ms for f in frames)};" + ",".join(f"{k}={n}" for k, n in enumerate(colours) if n)
                    row = (doc, len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(stored), hashlib.sha256(stored).hexdigest(), feature)
                    for name, value in zip(cols, row, strict=True):
                        cols[name].append(value)
                at += len(datas)
                yield pa.RecordBatch.from_pydict(cols, schema=_STORED)

    return slim(docs, id_col, text_col).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op8_gif(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` stored as a GIF, read back, with digests and a feature."""
    return stored_texts(table(spark, sf_dir, "documents"))
