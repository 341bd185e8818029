"""Named query plans: staging, star schema, marts, panels, and the batch jobs that run them."""
