"""Column functions: time parsing, HL7 v2 addressing, XML envelope extraction."""
