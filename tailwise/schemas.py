"""Table contracts: column names, types and nullability of the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The stored layouts.
_LAYOUTS = {
    "claims": """claim_id string NOT NULL, policy_id string NOT NULL, loss_date date NOT NULL, report_date date NOT NULL,
        claimant_name string, loss_type string NOT NULL, loss_description string, adjuster_notes string,
        claim_status string NOT NULL, county string, state string, zip_code string,
        catastrophe_code string, created_at timestamp NOT NULL, updated_at timestamp NOT NULL""",
    "payments": """payment_id string NOT NULL, claim_id string NOT NULL, payment_date date NOT NULL, payment_type string NOT NULL,
        payment_amount double NOT NULL, cumulative_paid double, reserve_amount double,
        payment_status string NOT NULL, check_number string, payee_name string, expense_type string,
        created_at timestamp NOT NULL""",
    "enriched_claims_contract": """claim_id string NOT NULL, policy_id string NOT NULL, loss_date date NOT NULL,
        report_date date NOT NULL, origin_year int NOT NULL, origin_quarter int NOT NULL, development_month int NOT NULL,
        loss_type string NOT NULL, adjuster_notes string, claim_status string NOT NULL, county string,
        state string, catastrophe_code string, cumulative_paid double NOT NULL, incurred_amount double NOT NULL,
        created_at timestamp NOT NULL""",
    "enriched_claims": """claim_id string NOT NULL, policy_id string, loss_date date, report_date date,
        loss_type string, loss_description string, adjuster_notes string, claim_status string,
        county string, state string, zip_code string, catastrophe_code string, origin_year int,
        origin_period int, latest_payment_date date, total_paid double, current_reserve double,
        incurred_amount double, risk_category string, risk_score double,
        risk_keywords array<string>, high_risk_flag boolean""",
    "loss_triangles": """triangle_id string NOT NULL, triangle_type string NOT NULL, loss_type string, state string,
        county string, origin_period int NOT NULL, development_period int NOT NULL, cumulative_value double,
        incremental_value double, claim_count int, period_type string NOT NULL, as_of_date date""",
    "development_factors": """triangle_type string NOT NULL, loss_type string, development_period int NOT NULL,
        ata_factor double, cdf_to_ultimate double, percent_developed double""",
    "reserve_estimates": """origin_period int NOT NULL, latest_cumulative double, ultimate_loss double,
        ibnr double, percent_reported double, triangle_type string NOT NULL, loss_type string,
        segment string, tail_factor double""",
    "reserve_summary": """as_of_date date NOT NULL, triangle_type string NOT NULL, loss_type string,
        total_paid double, total_ibnr double, total_ultimate double, reserve_adequacy double,
        held_reserves double, reserve_margin double, ai_adjustment_factor double""",
    "risk_summary": """origin_year int, loss_type string, total_claims bigint,
        high_risk_claims bigint, avg_risk_score double, total_incurred double,
        high_risk_incurred double, high_risk_pct double, high_risk_incurred_pct double""",
}

# Permitted enumeration members and required claim columns.
LOSS_TYPES = ("Water Damage", "Wind", "Fire", "Theft", "Liability", "Other")
CLAIM_STATUSES = ("Open", "Closed", "Reopened", "Pending")
REQUIRED_CLAIM_COLUMNS = (
    "claim_id", "policy_id", "loss_date", "report_date", "loss_type", "claim_status",
)


def contract(name: str) -> T.StructType:
    """The schema of a stored table."""
    return T.StructType.fromDDL(" ".join(_LAYOUTS[name].split()))


def contract_names() -> list[str]:
    return list(_LAYOUTS)


def text_schema(schema: T.StructType) -> T.StructType:
    """The same columns, all as nullable strings: how raw text files are read before casting."""
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema])


def cast_column(name: str, target: T.DataType) -> Column:
    """Cast that yields NULL for text that does not parse."""
    return F.col(name).try_cast(target).alias(name)


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast text columns to the types of ``schema``; other columns pass through."""
    extra = [c for c in df.columns if c not in schema.names]
    return df.select(*[cast_column(f.name, f.dataType) for f in schema], *extra)


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select and cast to a contract; nullable columns that are missing become NULL."""
    columns = []
    for field in contract(name):
        if field.name in df.columns:
            columns.append(F.col(field.name).cast(field.dataType).alias(field.name))
        elif field.nullable:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            raise ValueError(f"{name}: required column {field.name!r} is missing")
    return df.select(*columns)
