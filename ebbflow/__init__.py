"""Entity tables that live in two places, kept in step with Spark joins."""

from ebbflow.model import Attribute, Entity, EntityModel, Relationship, Status, Stored

__all__ = ["Attribute", "Entity", "EntityModel", "Relationship", "Status", "Stored"]
