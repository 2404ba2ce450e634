"""Relations of the warehouse: staging, sessions, clients, pages, articles, walls, subscriptions."""
