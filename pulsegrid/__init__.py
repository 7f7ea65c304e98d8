"""pulsegrid: a Spark-native engagement analytics engine.

Cleans and de-duplicates four channel activity logs (email, web, field rep,
event), builds per-entity features and data-quality reports, unifies and
normalises them, cuts point-in-time snapshots, scores entities and serves
dashboard/directory tables. Every operator is a ``DataFrame -> DataFrame``
function; nothing is pulled to the driver except a handful of fitted scalars.
"""

from pulsegrid.config import PROFILE_A, PROFILE_B, Profile, RunConfig

__all__ = ["Profile", "RunConfig", "PROFILE_A", "PROFILE_B"]
