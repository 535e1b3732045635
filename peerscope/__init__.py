"""peerscope: peer-place community-investment metrics as lazy Spark DataFrame plans.

Every public operator takes and returns a ``DataFrame`` (or ``Column``) and is
lazy.  Driver-side actions are limited to bounded metadata: file listings,
dimension row counts used to decide whether a broadcast is safe, and reliable
checkpoints that cut lineage for the order-statistics operators.
"""

__version__ = "0.1.0"
