"""Corporate entities, relationships, reporting exceptions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from siltstone.functions.text import code_label
from siltstone.operators.dimensions import role_parents

# Headings of the published files and the columns they become.
ENTITY = {
    "LEI": "lei",
    "Entity.LegalName": "legal_name",
    "Entity.LegalAddress.Country": "legal_country",
    "Entity.LegalAddress.City": "legal_city",
    "Entity.LegalAddress.PostalCode": "legal_postal_code",
    "Entity.HeadquartersAddress.Country": "hq_country",
    "Entity.HeadquartersAddress.City": "hq_city",
    "Entity.EntityStatus": "entity_status",
    "Entity.EntityCategory": "entity_category",
    "Entity.LegalForm.EntityLegalFormCode": "legal_form_code",
    "Registration.ValidationAuthority.ValidationAuthorityID": "validation_authority_id",
    "Registration.ValidationAuthority.ValidationAuthorityEntityID": "validation_authority_entity_id",
    "Registration.InitialRegistrationDate": "initial_registration_date",
    "Registration.LastUpdateDate": "last_update_date",
    "Registration.RegistrationStatus": "registration_status",
    "Registration.ManagingLOU": "managing_lou",
}
RELATIONSHIP = {
    "Relationship.StartNode.NodeID": "child_lei",
    "Relationship.StartNode.NodeIDType": "child_node_type",
    "Relationship.EndNode.NodeID": "parent_lei",
    "Relationship.EndNode.NodeIDType": "parent_node_type",
    "Relationship.RelationshipType": "relationship_type",
    "Relationship.RelationshipStatus": "relationship_status",
    "Relationship.Period.1.startDate": "period_start_date",
    "Relationship.Period.1.endDate": "period_end_date",
    "Registration.RegistrationStatus": "registration_status",
    "Registration.ManagingLOU": "managing_lou",
}
EXCEPTION = {
    "LEI": "lei",
    "Exception.Category": "exception_category",
    "Exception.Reason.1": "exception_reason",
    "Exception.Reference.1": "exception_reference",
}
REGISTRIES = {"RA000484": "KRS", "RA000654": "REGON"}
DIRECT, ULTIMATE, ACTIVE = "IS_DIRECTLY_CONSOLIDATED_BY", "IS_ULTIMATELY_CONSOLIDATED_BY", "ACTIVE"


def bronze(rows: DataFrame, headings: dict[str, str], as_of: datetime | None = None) -> DataFrame:
    """The wanted columns of a published file, all text."""
    stamp = F.current_timestamp() if as_of is None else F.lit(as_of)
    return rows.select(*[F.col(f"`{k}`").alias(v) for k, v in headings.items()], stamp.cast("string").alias("processed_at_utc"))


def dim_entity(entities: DataFrame, relationships: DataFrame) -> DataFrame:
    """Entities with their active direct and ultimate parents.

    Several active parents of one kind give several rows.
    """
    def active(kind: str):
        return (F.col("relationship_type") == kind) & (F.col("relationship_status") == ACTIVE)

    parents = role_parents(
        entities, relationships, "lei", "child_lei", "parent_lei", {"direct_parent_lei": active(DIRECT), "ultimate_parent_lei": active(ULTIMATE)}
    )
    return parents.drop("legal_form_code", "initial_registration_date", "last_update_date").withColumn(
        "national_registry_type", code_label("validation_authority_id", REGISTRIES)
    )
