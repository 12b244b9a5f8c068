"""Multi-step flows (dataset build, report, scoring) and the derived fixtures
that stand in for the reference's data in the registered checks."""
