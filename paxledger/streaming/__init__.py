"""Rules and admission on arriving bookings."""
