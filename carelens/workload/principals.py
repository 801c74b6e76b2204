"""Access keys of the demonstration: for the registered queries and tests only."""

from carelens.operators.security import CORPORATE, EXECUTIVE, REGIONAL, Principal

# Fixed values.
ACCESS_KEYS = {
    "demo-everything": Principal(CORPORATE),
    "demo-one-region": Principal(REGIONAL, region="Pacific Northwest"),
    "demo-one-community": Principal(EXECUTIVE, community_id="C001"),
}
