"""Writers and published views."""
