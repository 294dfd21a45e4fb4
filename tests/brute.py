"""Plain-Python versions of the daily jobs, for small frames."""

from collections import defaultdict
from datetime import timedelta
from decimal import Decimal

ONE_DAY = timedelta(days=1)


def day_rows(versions, plans, as_of, inclusive=False):
    """(dt, subscription, version index, status, price) in order of subscription and day."""
    out = []
    for index, (sub, plan, status, start, end) in enumerate(sorted(versions, key=lambda v: (v[0], v[3]))):
        last = as_of if end is None else (end if inclusive else end - ONE_DAY)
        dt = start
        while dt <= last:
            prices = [p for (pid, p, f, t) in plans if pid == plan and f <= dt and (t is None or dt <= t)]
            out.append((dt, sub, index, status, prices[0] if prices else None))
            dt += ONE_DAY
    return sorted(out, key=lambda r: (r[1], r[0], r[2]))


def kpis(rows):
    """Day to (mrr, new, expansion, contraction, churn, active, arr, arpu)."""
    total = defaultdict(lambda: [None, None, Decimal(0), Decimal(0), Decimal(0), 0])

    def add(cell, value):
        return cell if value is None else (cell or Decimal(0)) + value

    previous = {}
    for dt, sub, _, status, price in rows:
        was, paid = previous.get(sub, (None, None))
        paid = paid or Decimal(0)
        day = total[dt]
        day[0] = add(day[0], price if status == "active" else Decimal(0))
        day[1] = add(day[1], price if status == "active" and was != "active" else Decimal(0))
        if was == status == "active" and price is not None:
            day[2] += max(price - paid, Decimal(0))
            day[3] += max(paid - price, Decimal(0))
        if was == "active" and status is not None and status != "active":
            day[4] += paid
        day[5] += status == "active"
        previous[sub] = (status, price)
    cent = Decimal("0.01")
    result = {}
    for dt, (mrr, new, up, down, churn, n) in total.items():
        arpu = Decimal("0.00") if n == 0 else None if mrr is None else (mrr / n).quantize(cent, "ROUND_HALF_UP")
        result[dt] = (mrr, new, up, down, churn, n, None if mrr is None else mrr * 12, arpu)
    return result


def reached_periods(cohort, as_of):
    offsets = [("W1", 1, 7), ("M1", 2, 30), ("M3", 3, 90), ("M6", 4, 180), ("M12", 5, 360)]
    return [(n, i, cohort + timedelta(days=d)) for n, i, d in offsets if cohort + timedelta(days=d) <= as_of]
