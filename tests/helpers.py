import datetime
import decimal
import hashlib


def norm(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return str(v)


def canonical(rows, cols):
    """Order-insensitive canonical form: columns sorted by name, rows sorted."""
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)


def digest(rows, cols):
    return hashlib.md5("\n".join(canonical(rows, cols)).encode()).hexdigest()
