"""Own sample rows: expected values are worked out by hand from them."""

from __future__ import annotations

import json


def _row(kind, source, symbol, price, volume, event_time, batch, ingested):
    return {"asset_type": kind, "batch_id": batch, "event_time": event_time, "ingestion_time": ingested,
            "price": price, "source": source, "symbol": symbol, "volume": volume}


_S = ("batch-a", "2031-01-05T09:00:30+00:00")
SAMPLE_BATCH = [
    _row("stock", "nasdaq", "ALFA", "12.00", "200", "2031-01-05T09:00:00+00:00", *_S),
    _row("stock", "nasdaq", "BRVO", "240.50", "50", "2031-01-05T09:00:01+00:00", *_S),
    _row("crypto", "coinbase", "BTCUSD", "48000.00", "10.5", "2031-01-05T09:00:02+00:00", *_S),
    _row("crypto", "coinbase", "ETHUSD", "2000.00", "100.25", "2031-01-05T09:00:03+00:00", *_S),
]

# five stocks with one event time, three crypto ticks with nine fractional digits
_L = ("batch-b", "2031-02-02T11:23:00.000007+00:00")
LATEST_BATCH = [
    _row("stock", "nasdaq", "ALFA", "12.40", "5000", "2031-02-01T00:00:00+00:00", *_L),
    _row("stock", "nasdaq", "BRVO", "250.75", "320.5", "2031-02-01T00:00:00+00:00", *_L),
    _row("stock", "nasdaq", "CHAR", "99.10", "1200", "2031-02-01T00:00:00+00:00", *_L),
    _row("stock", "nasdaq", "DELT", "7.35", "88000000", "2031-02-01T00:00:00+00:00", *_L),
    _row("stock", "nasdaq", "ECHO", "41.20", "2500", "2031-02-01T00:00:00+00:00", *_L),
    _row("crypto", "coinbase", "BTCUSD", "50100.5", "2.25", "2031-02-02T11:22:33.123456789Z", *_L),
    _row("crypto", "coinbase", "ETHUSD", "2010.25", "40.125", "2031-02-02T11:22:31.987654321Z", *_L),
    _row("crypto", "coinbase", "SOLUSD", "81.50", "333.3", "2031-02-02T11:22:12.000000001Z", *_L),
]

# (rank, symbol, price, volume, price * volume)
LATEST_TOP = {
    "stock": [
        (1, "DELT", 7.35, 88000000.0, 646800000.0),
        (2, "CHAR", 99.1, 1200.0, 118920.0),
        (3, "ECHO", 41.2, 2500.0, 103000.0),
        (4, "BRVO", 250.75, 320.5, 80365.375),
        (5, "ALFA", 12.4, 5000.0, 62000.0),
    ],
    "crypto": [
        (1, "BTCUSD", 50100.5, 2.25, 112726.125),
        (2, "ETHUSD", 2010.25, 40.125, 80661.28125),
        (3, "SOLUSD", 81.5, 333.3, 27163.95),
    ],
}

SAMPLE_TOP = {
    "stock": [(1, "BRVO", 12025.0), (2, "ALFA", 2400.0)],
    "crypto": [(1, "BTCUSD", 504000.0), (2, "ETHUSD", 200500.0)],
}

ORDERS_CSV = """order_id,customer,status,amount
7001,Ada,complete,12.25
7002,Ben,pending,27.00
7003,Cleo,complete,50.00
7004,Ada,cancelled,3.10
"""


def write_jsonl(path, records, extra_lines=()):
    with open(path, "w", encoding="utf-8") as fh:
        for r in records:
            fh.write(json.dumps(r, sort_keys=True) + "\n")
        for line in extra_lines:
            fh.write(line + "\n")
    return str(path)
