import struct
import zlib


def rows(df, *columns):
    """Rows as plain tuples, sorted, nulls first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, str(v)) for v in t])


def png(width, height, channels, pixels):
    """PNG bytes of raw pixel values, row by row."""
    colour = {1: 0, 3: 2, 4: 6}[channels]

    def chunk(kind, data):
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))

    line = width * channels
    raw = b"".join(b"\0" + bytes(pixels[y * line : (y + 1) * line]) for y in range(height))
    head = struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)
    return (
        b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw))
        + chunk(b"IEND", b"")
    )


def plan_of(df):
    """The physical plan after running the query."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
