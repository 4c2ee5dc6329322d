"""Physical-plan helpers: the distributed ordered scan."""
