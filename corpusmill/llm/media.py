"""Ogg media columns: pages with checksums, packets from lacing values, logical streams, timestamps from granule positions.

The writer stores a payload as unsigned 8-bit mono samples. Blocks of samples are packets, dealt to two logical streams in turn;
the granule position of a page is the time, in samples, at which its last finished packet ends. The reader verifies every page's
checksum, reassembles packets, also those that run over several pages, separates the streams by serial number, and merges the
packets again by their timestamps.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, whole_text

RATE = 8000
BLOCK = 1 << 15
MAGIC = b"PCMU8\0"
_TURNED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))


def checksum(page: bytes) -> int:
    """Ogg's CRC-32 (polynomial 04C11DB7, most significant bit first, from 0, not inverted): the mirror image of zlib's."""
    mirrored = zlib.crc32(page.translate(_TURNED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(mirrored.to_bytes(4, "little").translate(_TURNED), "big")


def pages(packets: Iterable[tuple[bytes, int]], serial: int) -> Iterator[tuple[int, bytes]]:
    """(granule position, page) of one logical stream; one packet a page, or several pages where 255 lacing values are too few."""
    todo = list(packets)
    number = 0
    for k, (data, granule) in enumerate(todo):
        lacing = b"\xff" * (len(data) // 255) + bytes([len(data) % 255])
        for at in range(0, len(lacing), 255):
            part, last = lacing[at : at + 255], at + 255 >= len(lacing)
            kind = (1 if at else 0) | (2 if number == 0 else 0) | (4 if last and k == len(todo) - 1 else 0)
            head = struct.pack("<4sBBqIII", b"OggS", 0, kind, granule if last else -1, serial, number, 0)
            page = head + bytes([len(part)]) + part + data[at * 255 : at * 255 + sum(part)]
            yield granule, page[:22] + checksum(page).to_bytes(4, "little") + page[26:]
            number += 1


def write(payload: bytes) -> bytes:
    """The payload as an Ogg file of two logical streams; equal payloads, equal files."""
    serial = zlib.crc32(payload)
    serials = (serial, serial ^ 0x80000000)
    head = MAGIC + struct.pack("<IB", RATE, 1)
    lists: list[list[tuple[bytes, int]]] = [[(head, 0)], [(head, 0)]]
    for k, at in enumerate(range(0, len(payload), BLOCK)):
        block = payload[at : at + BLOCK]
        lists[k % 2].append((block, at + len(block)))
    made = [list(pages(p, s)) for p, s in zip(lists, serials, strict=True)]
    first = [made[0][0], made[1][0]]  # pages that begin a stream come before all others
    rest = sorted((granule, n, k, page) for n in (0, 1) for k, (granule, page) in enumerate(made[n][1:]))
    return b"".join([p for _, p in first] + [p for *_, p in rest])


@dataclass
class Stream:
    serial: int
    packets: list[tuple[bytes, int]] = field(default_factory=list)  # data, time at its end (-1 unknown)
    pending: bytes | None = None
    expected: int = 0
    ended: bool = False


@dataclass
class Ogg:
    streams: dict[int, Stream] = field(default_factory=dict)
    n_pages: int = 0
    bad_pages: int = 0  # wrong checksum, or cut off
    lost_pages: int = 0  # gaps in the numbering of a stream


def read(data: bytes) -> Ogg:
    """All streams of a file. A page that is damaged is counted and skipped; reading goes on at the next capture pattern, and the
    packet that the gap tears is dropped."""
    out, at = Ogg(), 0
    while (at := data.find(b"OggS", at)) >= 0:
        if at + 27 > len(data):
            out.bad_pages += 1
            break
        _, version, kind, granule, serial, number, crc = struct.unpack_from("<4sBBqIII", data, at)
        n = data[at + 26]
        lacing = data[at + 27 : at + 27 + n]
        start = at + 27 + n
        stop = start + sum(lacing)
        page = data[at:stop]
        if version or len(lacing) < n or stop > len(data) or checksum(page[:22] + b"\0\0\0\0" + page[26:]) != crc:
            out.bad_pages += 1
            at += 4
            continue
        out.n_pages += 1
        s = out.streams.setdefault(serial, Stream(serial))
        if number != s.expected:
            out.lost_pages += max(1, number - s.expected)
            s.pending = None
        s.expected, s.ended = number + 1, bool(kind & 4)
        parts, size, p = [], 0, start
        torn = bool(kind & 1) and s.pending is None  # goes on with a packet whose beginning is missing
        held = s.pending if kind & 1 and s.pending is not None else b""
        s.pending = None
        for v in lacing:
            size += v
            if v < 255:
                if not torn:
                    parts.append(held + data[p : p + size])
                torn, held, p, size = False, b"", p + size, 0
        if lacing and lacing[-1] == 255 and not torn:
            s.pending = held + data[p : p + size]
        s.packets += [(x, granule if k == len(parts) - 1 else -1) for k, x in enumerate(parts)]
        at = stop
    return out


def samples(ogg: Ogg) -> bytes:
    """The samples of all streams with our header, merged by the times at which their packets begin."""
    found = []
    for s in ogg.streams.values():
        if s.packets and s.packets[0][0].startswith(MAGIC):
            end = None
            for data, granule in reversed(s.packets[1:]):  # a packet without a position ends where the next begins
                end = granule if granule >= 0 else end
                found.append(((end if end is not None else 0) - len(data), data))
                end = found[-1][0]
    return b"".join(d for _, d in sorted(found, key=lambda x: x[0]))


def duration(ogg: Ogg) -> float:
    """Seconds: the largest granule position over the rate."""
    return max((g for s in ogg.streams.values() for _, g in s.packets), default=0) / RATE


def describe(ogg: Ogg, pcm: bytes) -> str:
    """Features of the samples as they were read back."""
    counts = np.bincount(np.frombuffer(pcm, dtype=np.uint8), minlength=256).astype(float)
    n, v = max(1, len(pcm)), np.arange(256) - 128.0
    mean = float(counts @ v) / n
    rms = float(np.sqrt(counts @ (v * v) / n))
    p = counts[counts > 0] / n
    packets = sum(len(s.packets) for s in ogg.streams.values())
    return f"pcm_u8 rate={RATE} streams={len(ogg.streams)} packets={packets} pages={ogg.n_pages} seconds={duration(ogg):.6f} mean={mean:.6f} rms={rms:.6f} levels={len(p)} entropy={float(-(p * np.log2(p)).sum()) + 0.0:.6f}"


def padded(data: bytes) -> bytes:
    """Zeros appended up to a positive multiple of 64."""
    return data + b"\0" * (-len(data) % 64 if data else 64)


def stored_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every whole text as an Ogg file, written, read back and described.

    Returns doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature; all but n_bytes and
    the two media columns from the bytes read back. Null text counts as empty and is stored as 64 zeros; equal texts give equal
    values; repeated rows are stored each; extra columns are ignored; an empty table gives an empty table.
    """

    def rows(it: Iterator[tuple]) -> Iterable[tuple]:
        for i, d in it:
            media = write(padded(d))
            ogg = read(media)
            pcm = samples(ogg)
            if ogg.bad_pages or ogg.lost_pages:
                raise ValueError(f"a page of the file just written for {i} cannot be read back")
            yield i, len(d), len(pcm), hashlib.sha256(pcm).hexdigest(), zlib.crc32(pcm[-64:]), len(media), hashlib.sha256(media).hexdigest(), describe(ogg, pcm)

    return map_rows(docs, [F.col(doc_id).alias("doc_id"), whole_text(text)], f"doc_id {dict(docs.dtypes)[doc_id]}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string", rows)


def inspect(files: DataFrame, key: str, media: str) -> DataFrame:
    """One row per row of ``files``: key, status, n_streams, n_pages, bad_pages, lost_pages, n_packets, seconds, of a binary
    column of Ogg files. status: ``empty`` (null or no bytes), ``not_ogg`` (no page), ``damaged`` or ``ok``."""

    def rows(it: Iterator[tuple]) -> Iterable[tuple]:
        for k, d in it:
            o = read(d or b"")
            status = "empty" if not d else "not_ogg" if not o.n_pages and not o.bad_pages else "damaged" if o.bad_pages or o.lost_pages else "ok"
            yield k, status, len(o.streams), o.n_pages, o.bad_pages, o.lost_pages, sum(len(s.packets) for s in o.streams.values()), duration(o)

    return map_rows(files, [F.col(key).alias("k"), F.col(media)], f"{key} {dict(files.dtypes)[key]}, status string, n_streams int, n_pages int, bad_pages int, lost_pages int, n_packets int, seconds double", rows)
