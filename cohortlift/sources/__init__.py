"""Reading, seeding, writing and stamping tables."""
