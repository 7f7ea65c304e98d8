"""Run parameters and the two scoring profiles.

Profile ``A`` is the notebook flavour (closed history window, lift-based next
best channel), profile ``B`` the scripted flavour (half-open windows, clipped
recency, probability-based next best channel). Dates are parameters: the
defaults fit the driver tables, whose activity spans 2024-01-01..2024-01-30.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class RunConfig:
    # date the feature recencies are measured from (DATEDIFF(as_of, last))
    as_of: dt.date = dt.date(2024, 2, 1)
    # first day covered by the activity data; the recency null-fill is the
    # day span data_start -> as_of (the reference uses 227 for its span)
    data_start: dt.date = dt.date(2024, 1, 1)

    @property
    def recency_fill(self) -> int:
        return (self.as_of - self.data_start).days


@dataclass(frozen=True)
class Profile:
    name: str
    # history window [T-h, T] when True, [T-h, T) otherwise
    hist_closed_right: bool
    # label window (T, T+f] when True, [T, T+f) otherwise
    label_open_left: bool
    # zero-safe ratio: "max1" -> a / max(b, 1); "eps" -> a / (b + 1e-5)
    ratio_guard: str
    clip_recency: bool
    web_engagement_types: tuple[str, ...]
    # event attendance flag: "activity" (activity type) or "status" (Attended)
    attendance_rule: str
    train_dates: tuple[dt.date, ...]
    val_dates: tuple[dt.date, ...]
    test_dates: tuple[dt.date, ...]
    current_date: dt.date
    hist_days: int = 60
    fut_days: int = 30
    channel_weights: tuple[float, float, float, float] = (0.10, 0.20, 0.30, 0.40)
    tier_cut_inclusive: bool = True
    next_best_by_lift: bool = True
    rep_label: str = "Sales Rep"
    quantiles: tuple[float, float] = (0.3333, 0.6667)
    learning_rate: float = 0.05
    class_weighted: bool = True
    # profile B: channel weights chosen by the Spearman grid, scores clipped to [0, 100]
    select_channel_weights: bool = False
    clip_scores: bool = False
    default_hybrid: int = 0
    extra: dict = field(default_factory=dict)

    def all_dates(self) -> list[tuple[dt.date, str]]:
        out = [(d, "train") for d in self.train_dates]
        out += [(d, "val") for d in self.val_dates]
        out += [(d, "test") for d in self.test_dates]
        out.append((self.current_date, "current"))
        return out


_D = dt.date

# The driver tables cover 30 days, so both profiles below override the 60 / 30 day
# windows of ``Profile`` with 15 / 7 days next to their dates.

# Channel order used for every 4-wide probability / label vector.
CHANNELS = ("email", "web", "webinar", "rep")

PROFILE_A = Profile(
    name="A",
    hist_days=15,
    fut_days=7,
    hist_closed_right=True,
    label_open_left=True,
    ratio_guard="max1",
    clip_recency=False,
    web_engagement_types=("content_view", "download", "video_complete"),
    attendance_rule="activity",
    train_dates=(_D(2024, 1, 8), _D(2024, 1, 10), _D(2024, 1, 12), _D(2024, 1, 14), _D(2024, 1, 16)),
    val_dates=(_D(2024, 1, 18), _D(2024, 1, 20)),
    test_dates=(_D(2024, 1, 22), _D(2024, 1, 23)),
    current_date=_D(2024, 1, 30),
    channel_weights=(0.10, 0.20, 0.30, 0.40),
    tier_cut_inclusive=True,
    next_best_by_lift=True,
    rep_label="Sales Rep",
    quantiles=(0.3333, 0.6667),
    learning_rate=0.05,
    class_weighted=True,
)

PROFILE_B = Profile(
    name="B",
    hist_days=15,
    fut_days=7,
    hist_closed_right=False,
    label_open_left=False,
    ratio_guard="eps",
    clip_recency=True,
    web_engagement_types=("content_view", "download", "video_start", "video_complete"),
    attendance_rule="status",
    train_dates=(_D(2024, 1, 10), _D(2024, 1, 13), _D(2024, 1, 16)),
    val_dates=(_D(2024, 1, 19),),
    test_dates=(_D(2024, 1, 22),),
    current_date=_D(2024, 1, 30),
    channel_weights=(0.25, 0.25, 0.25, 0.25),
    tier_cut_inclusive=False,
    next_best_by_lift=False,
    rep_label="Veeva",
    quantiles=(0.3333, 0.6667),
    learning_rate=0.03,
    class_weighted=False,
    select_channel_weights=True,
    clip_scores=True,
    default_hybrid=2,
)

PROFILES = {"A": PROFILE_A, "B": PROFILE_B}
