"""Graph objects and builders, the test-mode run, and the query catalog with
its SQL oracle."""
