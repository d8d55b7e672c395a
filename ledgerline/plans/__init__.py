"""Entity, fact, serving and operational plans."""
