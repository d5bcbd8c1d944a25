"""Relational operators over intake, audit, geometry, quality and answers."""
