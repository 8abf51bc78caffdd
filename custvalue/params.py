"""Run parameters, passed to every operator that needs a date or a bound."""

from __future__ import annotations

import dataclasses
import datetime as dt
import math


@dataclasses.dataclass(frozen=True)
class ClvParams:
    """Parameters of one run.

    ``threshold_date`` separates features from target, ``predict_end`` is the
    end of the data.  Customers who spent more than ``max_monetary`` before the
    threshold are left out of the feature table.
    """

    threshold_date: dt.date
    predict_end: dt.date
    max_monetary: float
    active_days: int = 90
    # "all": the target covers the whole period; "after": only later orders.
    target_window: str = "all"
    # "fail": an unreadable invoice date stops the job; "null": the line is left out.
    bad_dates: str = "fail"
    # Decimals of a unit price, 2 or more; a price with more stops the job.
    price_digits: int = 4
    # Caps, bounds of the split buckets, monthly discount, penalty.
    freq_clip: int = 600
    money_clip: float = 100000.0
    buckets: int = 100000
    train_hi: int = 70000
    eval_hi: int = 85000
    discount_rate: float = 0.01
    penalizer: float = 0.01

    def __post_init__(self) -> None:
        for name in ("threshold_date", "predict_end"):
            value = getattr(self, name)
            if isinstance(value, str):
                object.__setattr__(self, name, dt.date.fromisoformat(value))
            elif not isinstance(value, dt.date):
                raise TypeError(f"{name} must be a date or 'YYYY-mm-dd' text, got {value!r}")
        if self.target_window not in ("all", "after"):
            raise ValueError(f"target_window must be 'all' or 'after', got {self.target_window!r}")
        if self.price_digits < 2:
            raise ValueError(f"price_digits must be 2 or more, got {self.price_digits!r}")
        if self.bad_dates not in ("fail", "null"):
            raise ValueError(f"bad_dates must be 'fail' or 'null', got {self.bad_dates!r}")

    @property
    def time_days(self) -> int:
        """Length of the prediction period in days."""
        return (self.predict_end - self.threshold_date).days

    @property
    def time_months(self) -> int:
        """Length of the prediction period in started 30-day months."""
        return math.ceil(self.time_days / 30)
