"""Schemas and vendor settings: keys, features, sentinels of each vendor's snapshot."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "timestamp": T.TimestampType(), "boolean": T.BooleanType()}


def _struct(**fields: str) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in fields.items()])


#: Raw signals as they land.
SCORES_ZONAL = _struct(InstanceType="string", Region="string", AZ="string", SPS="int", TargetCapacity="int", T3="int", T2="int")
INTERRUPTIONS = _struct(Region="string", InstanceType="string", IF="double")
ONDEMAND_PRICES = _struct(Region="string", InstanceType="string", OndemandPrice="double")
SPOT_PRICES = _struct(InstanceType="string", AZ="string", SpotPrice="double")
RETAIL_ITEMS = _struct(location="string", armRegionName="string", armSkuName="string", retailPrice="double", meterName="string", productName="string", effectiveStartDate="string")
EVICTIONS = _struct(location="string", skuName="string", evictionRate="string")
CALLS = _struct(subscription="string", location="string", ts="timestamp")
SUPPORT = _struct(RegionCode="string", InstanceType="string")


@dataclass(frozen=True)
class Vendor:
    """What identifies a row of a vendor's snapshot, what is watched for changes, and what stands for a missing value."""

    name: str
    keys: tuple[str, ...]
    features: tuple[str, ...]
    sentinels: dict[str, object] = field(default_factory=dict)
    emit_removed: bool = True


VENDORS = {
    "aws": Vendor(
        "aws", ("InstanceType", "Region", "AZ"), ("SPS", "T3", "T2", "IF", "SpotPrice", "OndemandPrice"),
        {"SPS": -1, "T3": 0, "T2": 0, "IF": -1.0, "SpotPrice": -1.0, "OndemandPrice": -1.0, "Savings": -1},
    ),
    "azure": Vendor(
        "azure", ("InstanceTier", "InstanceType", "Region", "AvailabilityZone", "DesiredCount"), ("OndemandPrice", "SpotPrice", "IF", "Score", "T2", "T3"),
        {"InstanceTier": "N/A", "InstanceType": "N/A", "Region": "N/A", "AvailabilityZone": "N/A", "OndemandPrice": -1.0, "SpotPrice": -1.0,
         "Savings": -1.0, "IF": -1.0, "DesiredCount": -1, "Score": -1, "T2": 0, "T3": 0}, emit_removed=False,
    ),
    "gcp": Vendor("gcp", ("InstanceType", "Region"), ("OndemandPrice", "SpotPrice")),
}
