"""Config rows shared by several test modules."""

from tributary.schemas import DELIVERY_CONFIG

ARN = "arn:aws:iam::123456789012:role/LogDistributionRole"


def table(spark, *rows):
    names = [f.name for f in DELIVERY_CONFIG]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], DELIVERY_CONFIG)


def cw(tenant, **more):
    return {"tenant_id": tenant, "type": "cloudwatch", "enabled": True, "log_distribution_role_arn": ARN,
            "log_group_name": f"/logs/{tenant}", **more}


def s3(tenant, **more):
    return {"tenant_id": tenant, "type": "s3", "enabled": True, "bucket_name": f"{tenant}-logs", **more}
