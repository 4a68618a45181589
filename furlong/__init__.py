"""furlong: race ROI features as Spark DataFrame jobs.

Inputs are three DataFrames (races, runners, horses; payouts where bets are
settled) held in a :class:`~furlong.schema.RaceTables`; every operator returns a lazy
DataFrame built from built-in Spark expressions.
"""

from furlong.schema import RaceTables
from furlong.operators.runners import rated_runners
from furlong.operators.roi import roi_by, roi_totals
from furlong.operators.reports import (
    jockey_course_roi,
    jockey_popularity_roi,
    jockey_surface_condition_roi,
    sire_track_condition_roi,
)
from furlong.operators.lookups import (
    horse_sire_track_roi_feature,
    jockey_course_feature,
    sire_track_roi_rank,
)
from furlong.operators.pedigree import flatten_tree, pedigree_rows, pedigree_tree
from furlong.operators.extras import (
    broodmare_sire_track_roi,
    closing_rank_roi,
    horse_course_roi,
    next_run_roi,
)
from furlong.operators.as_of import jockey_course_record_as_of, sire_track_record_as_of, totals_before
from furlong.operators.breeding import resolved_horses
from furlong.operators.careers import losing_streak_roi, with_streaks
from furlong.operators.names import jockey_names_on, name_intervals, names_on
from furlong.operators.payouts import jockey_payout_roi, settled_runners, win_payouts
from furlong.operators.pedigree_paths import inbreeding, line_cross_roi
from furlong.operators.quarantine import screen
from furlong.operators.stamina import stamina_index
from furlong.sources.totals_store import TotalsStore

__all__ = [
    "RaceTables",
    "rated_runners",
    "roi_by",
    "roi_totals",
    "sire_track_condition_roi",
    "jockey_course_roi",
    "jockey_popularity_roi",
    "jockey_surface_condition_roi",
    "jockey_course_feature",
    "horse_sire_track_roi_feature",
    "sire_track_roi_rank",
    "pedigree_rows",
    "pedigree_tree",
    "flatten_tree",
    "broodmare_sire_track_roi",
    "horse_course_roi",
    "closing_rank_roi",
    "next_run_roi",
    "totals_before",
    "jockey_course_record_as_of",
    "sire_track_record_as_of",
    "TotalsStore",
    "win_payouts",
    "settled_runners",
    "jockey_payout_roi",
    "name_intervals",
    "names_on",
    "jockey_names_on",
    "with_streaks",
    "losing_streak_roi",
    "stamina_index",
    "screen",
    "inbreeding",
    "line_cross_roi",
    "resolved_horses",
]
