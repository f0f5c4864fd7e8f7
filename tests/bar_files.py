"""Landed CSV files for tests."""

import csv
from datetime import date, timedelta

HEADER = ["timestamp", "open", "high", "low", "close", "volume"]


def land(folder, vendor_id, day, rows, header=HEADER):
    """Write one landed CSV; ``rows`` None makes it zero bytes."""
    following = (date.fromisoformat(day) + timedelta(days=1)).isoformat()
    path = folder / f"{vendor_id}-s1-bid-{day}-{following}.csv"
    with path.open("w", newline="") as out:
        if rows is not None:
            writer = csv.writer(out)
            writer.writerow(header)
            writer.writerows(rows)
    return path


def bars(day, minutes, price=1.0, volume=1.0):
    """One CSV row per minute given, in the order of HEADER."""
    return [[f"{day} {m // 60:02d}:{m % 60:02d}", price, price, price, price, volume] for m in minutes]
