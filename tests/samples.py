"""Small files in the shape of the real ones."""

from weighbridge.schemas import REQUIRED_HEADERS

HEADER = ",".join(REQUIRED_HEADERS)


def row(no, scale="Scale-01", fill="21.50kg", success="Y", at="2026-02-08 14:15:00", seconds="88"):
    cells = dict.fromkeys(REQUIRED_HEADERS, "7.25kg") | {
        "TransactNo": no, "Scale Name": scale, "CylSize": 19, "Fill kgs": fill, "Success": success,
        "Date Time Start": at, "Fill Time": seconds,
    }
    return ",".join(str(c) for c in cells.values())


def csv_bytes(*rows, header=HEADER, end="\n"):
    return (end.join([header, *rows]) + end).encode()


def write(folder, name, content):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content)
    return path
